"""Blocks of token ids, coded by an adaptive context-mixing range coder.

A block is coded in lanes: lane j takes the j-th stretch of its ids, and all lanes advance one id at
a time, sharing one model. Three predictions are mixed for each id:

* order 2: the id last seen after the two ids before it (hashed), with a confidence;
* order 1: the id last seen after the id before it, with a confidence;
* order 0: the frequencies of the block's ids so far, every id of the vocabulary possible.

The orders 2 and 1 are point predictions. Their weights and that of order 0 are learned: counts of
"order 2 was right", "order 1 was right", "neither", kept for each pair of confidences and for
whether both agree. The chosen outcome takes its share of the range, and under "neither" the id
takes its order-0 share of that.

Every lane has a carryless range coder of 64 bits that puts out 16 bits at a time. Lanes, model and
coder start anew with each block, so a block is decoded from its own bytes; a checksum of its bytes
and one of its ids guard it. Numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDB1"
HEAD = struct.Struct("<4sIIIII")  # magic, ids, lanes, vocabulary, bytes of the body, crc of the ids

LANE_IDS = 256  # a lane has about so many ids or more
MAX_LANES = 8192
TABLE_BITS = 18
ORDER0_BITS = 19
MIX_BITS = 12
ADAPT_EVERY = 4  # steps between new weights
REBUILD_EVERY = 24  # steps between new order-0 frequencies, once the block has begun

_U16, _U32, _U48, _TOP = (np.uint64(x) for x in (16, 1 << 32, 48, 1 << 48))
# What a right prediction adds to a table's entry, by its confidence, and one more.
_MORE = np.array([2, 2, 2, 1], np.int32)
_LOW32 = np.uint64((1 << 32) - 1)


class Model:
    def __init__(self, vocabulary: int):
        if not 0 < vocabulary <= 1 << 17:
            raise ValueError("ids must be below 131072")
        self.vocabulary = vocabulary
        # Of each context: the predicted id times 4, and a confidence of 0 to 3.
        self.table2 = np.zeros(1 << TABLE_BITS, np.int32)
        self.table1 = np.zeros(vocabulary, np.int32)
        self.outcomes = np.ones((32, 3), np.int64) * [1, 1, 2]
        self.pending: list[np.ndarray] = []
        self.seen = np.zeros(vocabulary, np.int64)
        self.shares()
        self.order0()

    def shares(self) -> None:
        """Ranges of the three outcomes in each context, out of 1 << MIX_BITS."""
        total = self.outcomes.sum(1, keepdims=True)
        width = 1 + self.outcomes * ((1 << MIX_BITS) - 3) // total
        width[:, 2] += (1 << MIX_BITS) - width.sum(1)
        start = np.cumsum(width, 1) - width
        self.mix_width, self.mix_start = (x.astype(np.uint64).ravel() for x in (width, start))
        self.mix_second, self.mix_third = start[:, 1].astype(np.uint64), start[:, 2].astype(np.uint64)

    def order0(self) -> None:
        """Ranges of all ids, out of 1 << ORDER0_BITS."""
        spare = (1 << ORDER0_BITS) - self.vocabulary
        width = 1 + self.seen * spare // max(1, int(self.seen.sum()))
        width[0] += (1 << ORDER0_BITS) - int(width.sum())
        self.width0 = width.astype(np.uint64)
        self.start0 = (np.cumsum(width) - width).astype(np.uint64)
        self.counts0 = width

    def find0(self) -> np.ndarray:
        """Id at every point of the order-0 range."""
        return np.repeat(np.arange(self.vocabulary, dtype=np.int32), self.counts0)

    def predict(self, two: np.ndarray, one: np.ndarray) -> None:
        """two and one: the ids before the one before, and before, as unsigned 64-bit numbers."""
        key = two * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xD6E8FEB86659FD93)
        self.slot2 = (key >> np.uint64(64 - TABLE_BITS)).view(np.int64)
        self.slot1 = one.view(np.int64)
        self.had2, self.had1 = self.table2[self.slot2], self.table1[self.slot1]
        self.p2, self.p1 = self.had2 >> 2, self.had1 >> 2
        self.t2, self.t1 = self.had2 & 3, self.had1 & 3
        context = self.t2 * 4 + self.t1
        context += context
        context += self.p2 == self.p1
        self.context = context

    def learn(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        for table, slot, had, trust, predicted in (
            (self.table2, self.slot2, self.had2, self.t2, self.p2),
            (self.table1, self.slot1, self.had1, self.t1, self.p1),
        ):
            right = predicted == ids
            known = had - 1 + right * _MORE[trust]
            lost = np.flatnonzero((trust == 0) & ~right)
            known[lost] = ids[lost] * 4
            table[slot] = known
        self.pending.append(self.context * 3 + outcome)

    def adapt(self) -> None:
        """Enters the outcomes since the last call."""
        counts = np.bincount(np.concatenate(self.pending), minlength=96)
        self.outcomes += counts.reshape(32, 3)
        self.pending.clear()
        self.shares()

def _lanes(n: int) -> tuple[int, int]:
    """Number of lanes and steps."""
    lanes = min(MAX_LANES, max(1, n // LANE_IDS))
    return lanes, -(-n // lanes)


def _due(step: int) -> bool:
    return step > 0 and (step & (step - 1) == 0 or step % REBUILD_EVERY == 0)


def _settle(low: np.ndarray, width: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Lanes of ``at`` whose top 16 bits are settled; narrow ranges are cut to settle."""
    below, span = low[at], width[at]
    inside = (below ^ (below + span)) < _TOP
    narrow = span < _U32
    if narrow.any():
        cut = at[narrow & ~inside]
        width[cut] = (~low[cut] + np.uint64(1)) & _LOW32
        inside |= narrow
    return at[inside]


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    ids = np.ascontiguousarray(ids, np.int32)
    n = len(ids)
    if n and not (0 <= int(ids.min()) and int(ids.max()) < vocabulary):
        raise ValueError("an id is outside the vocabulary")
    lanes, steps = _lanes(n)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = grid.reshape(lanes, steps).T.copy()
    model = Model(vocabulary)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, (1 << 64) - 1, np.uint64)
    room = 3 * steps + 8
    out = np.zeros(lanes * room, np.uint16)
    put = np.arange(lanes)
    two = one = np.zeros(lanes, np.uint64)
    everyone, since = np.arange(lanes), 0
    for step in range(steps):
        live = -(-(n - step) // steps)  # lanes that have an id here come first
        if _due(step):
            done = grid[since:step, :live] if live == lanes else grid[since:step]
            model.seen += np.bincount(done.ravel(), minlength=vocabulary)
            model.order0()
            since = step
        now = grid[step, :live]
        model.predict(two[:live], one[:live])
        outcome = (model.p2 != now).astype(np.int32)
        outcome += outcome & (model.p1 != now)
        share = width[:live] >> np.uint64(MIX_BITS)
        cell = model.context * 3 + outcome
        low[:live] += share * model.mix_start[cell]
        width[:live] = share * model.mix_width[cell]
        rest = np.flatnonzero(outcome == 2)
        share = width[rest] >> np.uint64(ORDER0_BITS)
        chosen = now[rest]
        low[rest] += share * model.start0[chosen]
        width[rest] = share * model.width0[chosen]
        model.learn(now, outcome)
        if step < 16 or step % ADAPT_EVERY == 0:
            model.adapt()
        at = _settle(low, width, everyone[:live])
        while len(at):
            below, place = low[at], put[at]
            out[place] = below >> _U48
            put[at] = place + lanes
            low[at] = below << _U16
            width[at] = width[at] << _U16
            at = _settle(low, width, at)
        two, one = one, grid[step].astype(np.uint64)
    for _ in range(4):
        out[put] = low >> _U48
        put += lanes
        low <<= _U16
    sizes = (put // lanes).astype("<u4")
    used = np.arange(int(sizes.max()))[:, None] < sizes
    words = out.reshape(room, lanes)[: len(used)][used].astype("<u2")
    table = zlib.compress(sizes.tobytes(), 6)
    body = struct.pack("<I", len(table)) + table + words.tobytes()
    head = HEAD.pack(MAGIC, n, lanes, vocabulary, len(body), zlib.crc32(ids.astype("<u4").tobytes()))
    return head + body + struct.pack("<I", zlib.crc32(head + body))


def decode_block(block: bytes | memoryview) -> np.ndarray:
    """Ids of a block; ValueError if its bytes or ids do not agree with their checksums."""
    magic, n, lanes, vocabulary, size, crc = HEAD.unpack_from(block)
    end = HEAD.size + size
    if magic != MAGIC or len(block) < end + 4:
        raise ValueError("not a whole block")
    if zlib.crc32(block[:end]) != struct.unpack_from("<I", block, end)[0]:
        raise ValueError("the checksum of a block's bytes differs")
    (table,) = struct.unpack_from("<I", block, HEAD.size)
    begin = HEAD.size + 4
    sizes = np.frombuffer(zlib.decompress(block[begin : begin + table]), "<u4").astype(np.int64)
    words = np.frombuffer(block, "<u2", (end - begin - table) // 2, begin + table)
    # A lane that has read its last word may ask for one more, which no id depends on.
    used = np.arange(int(sizes.max()) + 1)[:, None] < sizes
    stream = np.zeros(used.shape, np.uint16)
    stream[used] = words
    words, take = stream.ravel(), np.arange(lanes)
    steps = -(-n // lanes)
    grid = np.zeros((steps, lanes), np.int32)
    model = Model(vocabulary)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, (1 << 64) - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = code << _U16 | words[take]
        take += lanes
    two = one = np.zeros(lanes, np.uint64)
    everyone, since = np.arange(lanes), 0
    find0 = model.find0()
    for step in range(steps):
        live = -(-(n - step) // steps)
        if _due(step):
            done = grid[since:step, :live] if live == lanes else grid[since:step]
            model.seen += np.bincount(done.ravel(), minlength=vocabulary)
            model.order0()
            find0 = model.find0()
            since = step
        model.predict(two[:live], one[:live])
        share = width[:live] >> np.uint64(MIX_BITS)
        point = np.minimum((code[:live] - low[:live]) // share, np.uint64((1 << MIX_BITS) - 1))
        outcome = (point >= model.mix_second[model.context]).astype(np.int32)
        outcome += point >= model.mix_third[model.context]
        cell = model.context * 3 + outcome
        low[:live] += share * model.mix_start[cell]
        width[:live] = share * model.mix_width[cell]
        now = np.where(outcome == 0, model.p2, model.p1)
        rest = np.flatnonzero(outcome == 2)
        share = width[rest] >> np.uint64(ORDER0_BITS)
        point = np.minimum((code[rest] - low[rest]) // share, np.uint64((1 << ORDER0_BITS) - 1))
        found = find0[point.view(np.int64)]
        now[rest] = found
        low[rest] += share * model.start0[found]
        width[rest] = share * model.width0[found]
        grid[step, :live] = now
        model.learn(now, outcome)
        if step < 16 or step % ADAPT_EVERY == 0:
            model.adapt()
        at = _settle(low, width, everyone[:live])
        while len(at):
            place = take[at]
            code[at] = code[at] << _U16 | words[place]
            take[at] = place + lanes
            low[at] = low[at] << _U16
            width[at] = width[at] << _U16
            at = _settle(low, width, at)
        two, one = one, grid[step].astype(np.uint64)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("the checksum of a block's ids differs")
    return ids
