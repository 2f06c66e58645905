"""Byte-level BPE encoding with a pair occurrence index, and decoding.

The distinct pre-tokens of a batch lie as linked symbols in one list. An index maps every pair that
has a rank to all its positions. Ranks are applied in ascending order over the whole batch: each
merge takes the positions of its pair from left to right, skips those that an earlier merge has
used, and enters the pairs it makes under their own ranks. A merge of a pair can only make pairs of
higher rank, as each token of the vocabulary is made by one merge; the loader checks that.

Null text: empty. Rows with equal ids are encoded one by one; a null id is kept. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import prepared
from dossierlake.llm.tokens import byte_letters

TOKENIZER = "byte_bpe_50k.json"

# Pre-tokens that a worker remembers, their longest length in characters, and the bytes of text
# that are encoded together at most (a longer text is encoded alone).
MEMO_ROOM = 500_000
MEMO_LETTERS = 40
TOGETHER = 4 << 20

_loaded: dict[str, "PairIndexBpe"] = {}


class PairIndexBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.byte_ids = np.array([vocab[letter] for letter in byte_letters()], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.spelling: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.spelling[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.spelling[i] = token.encode()
        if len({a + b for a, b in merges}) != len(merges):
            raise ValueError("two merges make the same token")
        self.size = size
        # Pairs in order with their ranks; by rank, both sides and what they become.
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]
        self.merge = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.decimal = [b"%d," % i for i in range(size)]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.memo: dict[str, bytes] = {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, or -1."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        real = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(real, self.pair_ranks[at], -1)

    def merge_all(self, words: list[str]) -> list[bytes]:
        """Ids of every pre-token, all merged together."""
        if not words:
            return []
        raw = [word.encode() for word in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        # Symbols of a word, then -1 as its end; the last end is also what stands before the first.
        ends = np.cumsum(lengths + 1) - 1
        symbols = np.full(int(ends[-1]) + 1, -1, np.int32)
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        after = np.arange(1, len(symbols) + 1, dtype=np.int64)
        before = np.arange(-1, len(symbols) - 1, dtype=np.int64)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            """Adds pairs to the lists of their ranks."""
            ranks = self.ranked(left, right)
            keep = np.flatnonzero(ranks >= 0)
            if not len(keep):
                return
            order = keep[np.argsort(ranks[keep], kind="stable")]
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(ranks)]
            for rank, i, j in zip(ranks[bounds[:-1]].tolist(), bounds, bounds[1:]):
                if rank in index:
                    index[rank].append(positions[i:j])
                else:
                    index[rank] = [positions[i:j]]
                    heapq.heappush(active, rank)

        pairs = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
        enter(pairs, symbols[pairs], symbols[pairs + 1])
        while active:
            rank = heapq.heappop(active)
            first, second, made = self.merge[rank]
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            behind = after[at]
            live = (symbols[at] == first) & (symbols[behind] == second)
            at, behind = at[live], behind[live]
            if first == second:  # in a run of equal symbols every other pair is taken
                taken, last = [], -1
                for n, (i, j) in enumerate(zip(at.tolist(), behind.tolist(), strict=True)):
                    if i != last:
                        taken.append(n)
                        last = j
                at, behind = at[taken], behind[taken]
            if not len(at):
                continue
            symbols[at], symbols[behind] = made, -2
            right = after[behind]
            after[at], before[right] = right, at
            left = before[at]
            enter(
                np.concatenate([at, left]),
                np.concatenate([symbols[at], symbols[left]]),
                np.concatenate([symbols[right], symbols[at]]),
            )
        kept = symbols >= 0
        ids = symbols[kept].astype("<u4").tobytes()
        cuts = (4 * np.cumsum(kept)[ends]).tolist()
        return [ids[i:j] for i, j in zip([0, *cuts], cuts)]

    def pre_tokens(self, text: str) -> list[str | int]:
        """Pre-tokens in order; a special token stands as its id."""
        if self.marks is None or not any(mark in text for mark in self.special):
            return self.pattern.findall(text)
        out: list[str | int] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.pattern.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers."""
        memo = self.memo
        if len(memo) > MEMO_ROOM:
            memo.clear()
        split = [self.pre_tokens(text or "") for text in texts]
        fresh: set = set()
        for tokens in split:
            fresh.update(tokens)
        special = {i: array("I", [i]).tobytes() for i in fresh if isinstance(i, int)}
        missing = [t for t in fresh if t not in memo and t not in special]
        found = dict(zip(missing, self.merge_all(missing), strict=True))
        long = {t: ids for t, ids in found.items() if len(t) > MEMO_LETTERS} | special
        memo.update((t, ids) for t, ids in found.items() if len(t) <= MEMO_LETTERS)
        out = []
        for tokens in split:
            if long and not long.keys().isdisjoint(tokens):
                out.append(b"".join(long[t] if t in long else memo[t] for t in tokens))
            else:
                out.append(b"".join(map(memo.__getitem__, tokens)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")


def bpe(tokenizer: str) -> PairIndexBpe:
    """The encoder of this worker."""
    if tokenizer not in _loaded:
        _loaded[tokenizer] = PairIndexBpe(public_tokenizers.path(tokenizer))
    return _loaded[tokenizer]


def groups(texts: list[str | None], room: int = TOGETHER) -> Iterator[list[str | None]]:
    """Consecutive texts of about so many characters."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text or "") > room:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    if group:
        yield group


def encode_documents(
    docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and its ids."""
    return _mapped(docs, tokenizer, id_col, text_col, "doc_id bigint, ids array<int>", _ids_only)


def round_trip(
    docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, number and digest of its ids, and digest of the text they decode to."""
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, tokenizer, id_col, text_col, kinds, _digests)


def _mapped(docs, tokenizer, id_col, text_col, kinds, rows_of) -> DataFrame:
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(tokenizer)
        for batch in batches:
            encoded: list[bytes] = []
            for group in groups(batch.column(1).to_pylist()):
                encoded += coder.encode(group)
            columns = rows_of(coder, encoded)
            names = ["doc_id", *columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns.values()], names)

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, kinds)


def _ids_only(coder: PairIndexBpe, encoded: list[bytes]) -> dict[str, pa.Array]:
    ids = [np.frombuffer(e, np.int32) for e in encoded]
    return {"ids": pa.array(ids, pa.list_(pa.int32()))}


def _digests(coder: PairIndexBpe, encoded: list[bytes]) -> dict[str, pa.Array]:
    counts, ids_sha, text_sha = [], [], []
    for raw in encoded:
        ids = np.frombuffer(raw, np.uint32).tolist()
        counts.append(len(ids))
        ids_sha.append(hashlib.sha256(b"".join(map(coder.decimal.__getitem__, ids))[:-1]).hexdigest())
        text_sha.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
    return {
        "n_tokens": pa.array(counts, pa.int64()),
        "ids_sha256": pa.array(ids_sha, pa.string()),
        "decoded_sha256": pa.array(text_sha, pa.string()),
    }
