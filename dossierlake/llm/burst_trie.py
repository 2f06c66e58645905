"""A prefix trie of conversations, built as a burst trie.

Conversations are rebuilt from their own turns and the first turns of another one, and equal ones become
one sequence with a weight. A suffix container holds what is left of the sequences below a trie head;
the first one holds all of them below the root. A container with more than ``LIMIT`` turns bursts by next
turn id: the turns that all its sequences share become a chain of nodes, and each turn that follows the
chain becomes a head with a container of its own. A container that is too big but holds one sequence is
all chain. The others, each at most ``LIMIT`` turns, are sorted and swept into nodes with one stack. Sums
over subtrees are made in the sweep for containers and, from the last burst to the first, by grouped sums
for heads and chains.

Chains and very long conversations are dealt out in blocks of ``BLOCK`` turns; positions of turns come
from ranges of their order. So neither a conversation nor a group of equal ones is in one task. A SHA-256
is one stream, though: the ids of equal conversations are joined to pieces of ``PIECE`` ids in parallel, and
one task hashes the pieces of a group in their order.

Null conv_id: no conversation. Null turn: first. Null role or text: empty. Turns of one number are ordered
by the digest of role and text, so repeated rows are repeated turns. Empty table: no nodes, not even
the root. A conversation with no turns left belongs to the root. Other columns are not read. Turns are
compared by a 128-bit digest and sequences by 128 bits made of those digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierlake.llm.frames import join_busy, prepared
from dossierlake.operators.numbering import in_ranges, place, runs
from dossierlake.session import materialize

# Fixed values of the rebuilt conversations: turns taken from the first conversation of its hundred.
HUNDRED = 100
SHARED = 6
LIMIT = 512
BLOCK = 4096
PIECE = 1 << 16

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, end_conv bigint"
TOTAL = "head bigint, head_depth bigint, children bigint, leaves bigint, saved bigint"
HEAD = ["head", "head_depth"]


def block_of(depth: Column) -> Column:
    return F.floor((depth - 1) / BLOCK)


def turn_rows(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        digest.alias("id"), F.length(text).cast("bigint").alias("chars"),
    )
    return rows.where("conv IS NOT NULL")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv), and the turns (conv, block, depth, id, chars) of the rebuilt ones."""
    placed = in_ranges(turns, ["conv", "turn", "id"], "turns")
    held = materialize(runs(placed, ["conv"]), "turn-runs")
    convs = held.groupBy("conv").agg(F.sum("n").alias("n"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % HUNDRED)
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    own = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    plan = convs.join(bases, "base", "left").withColumn("h", own)
    plan = plan.select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    plan = materialize(plan, "rebuild-plan")
    own = place(placed, held.join(plan.select("conv", "h", "taken"), "conv"), ["conv"], ["turn", "id"], "i")
    own = materialize(own.select("conv", "h", "taken", "i", "id", "chars"), "placed-turns")
    first = own.where(F.col("i") < SHARED).where(F.col("conv") % HUNDRED == 0).select(F.col("conv").alias("base"), "i", "id", "chars")
    first = first.join(plan.select("conv", "base", "taken"), "base").where("i <= taken")
    rest = own.where("i > h").select("conv", (F.col("taken") + F.col("i") - F.col("h")).alias("depth"), "id", "chars")
    rows = rest.unionByName(first.select("conv", F.col("i").alias("depth"), "id", "chars"))
    return plan.select("conv"), materialize(rows.withColumn("block", block_of(F.col("depth"))), "rebuilt-turns")


def sequences(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sequence (x, y, len) of each conversation, and per sequence its smallest conv and its weight."""
    parts = turns.groupBy("conv").agg(
        F.bit_xor(F.xxhash64("depth", "id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "depth", "id")).alias("y"),
        F.count("*").alias("len"),
    )
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("x", "y", "len")]
    keys = materialize(convs.join(parts, "conv", "left").select("conv", *zero), "sequence-keys")
    distinct = keys.groupBy("x", "y", "len").agg(F.min("conv").alias("conv"), F.count("*").alias("w"))
    return keys, materialize(distinct.select("conv", "len", "w"), "sequences")


def _blocks(state: DataFrame, start: Column) -> DataFrame:
    """A row for each block of the turns from ``start`` on."""
    return state.withColumn("block", F.explode(F.sequence(block_of(start), block_of(F.col("len")))))


def end_digests(keys: DataFrame) -> DataFrame:
    """end_conv, the smallest id of a group of equal conversations, and the SHA-256 of all its ids."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["x", "y", "len"]
    rows = keys.repartitionByRange(parts, *group, "conv").sortWithinPartitions(*group, "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []
        for batch in batches:
            out = []
            for conv, *key in zip(*(batch.column(c).to_pylist() for c in ("conv", *group)), strict=True):
                if key != held or len(ids) == PIECE:
                    out += [(*held, ids[0], ",".join(map(str, ids)))] if ids else []
                    held, ids = key, []
                ids.append(conv)
            yield _batch(out, "x bigint, y bigint, len bigint, conv bigint, ids string")
        if ids:
            yield _batch([(*held, ids[0], ",".join(map(str, ids)))], "x bigint, y bigint, len bigint, conv bigint, ids string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, state = None, None, None
        for batch in batches:
            out = []
            for conv, ids, *key in zip(*(batch.column(c).to_pylist() for c in ("conv", "ids", *group)), strict=True):
                if key != held:
                    out += [(first, state.hexdigest())] if held else []
                    held, first, state = key, conv, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out, "end_conv bigint, ends_sha256 string")
        if held:
            yield _batch([(first, state.hexdigest())], "end_conv bigint, ends_sha256 string")

    joined = rows.mapInArrow(pieces, "x bigint, y bigint, len bigint, conv bigint, ids string")
    joined = joined.repartition(parts, *group).sortWithinPartitions(*group, "conv")
    return joined.mapInArrow(digests, "end_conv bigint, ends_sha256 string")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string()}[kind] for _, kind in fields]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# -- sweeping a container ---------------------------------------------------------------


@dataclass(slots=True)
class Node:
    parent: Node | None
    depth: int
    chars: int
    conv: int
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    end: int | None = None


def sweep(head: int, head_depth: int, suffixes: list[tuple[list[bytes], list[int], int, int]]) -> tuple[list[tuple], tuple]:
    """Nodes of a container, and its totals.

    A suffix is turn ids, their characters, the smallest conversation and the weight of a sequence.
    """
    top = Node(None, head_depth, 0, head)
    nodes, open_ = [], [top]

    def close(keep: int) -> None:
        while len(open_) > keep:
            node = open_.pop()
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.chars
            node.parent.leaves += node.leaves
            node.parent.saved += node.saved

    before: list[bytes] = []
    for ids, chars, conv, weight in sorted(suffixes):
        shared = 0
        while shared < min(len(ids), len(before)) and ids[shared] == before[shared]:
            shared += 1
        close(shared + 1)
        for at in range(shared, len(ids)):
            node = Node(open_[-1], head_depth + at + 1, chars[at], conv)
            node.parent.children += 1
            open_.append(node)
            nodes.append(node)
        for node in open_[1:]:
            node.n += weight
            node.conv = min(node.conv, conv)
        open_[-1].end = conv
        before = ids
    close(1)
    rows = [(v.conv, v.depth, v.parent.conv, v.n, v.children, v.leaves, v.saved, v.end) for v in nodes]
    return rows, (head, head_depth, top.children, top.leaves, top.saved)


def swept(rows: DataFrame) -> DataFrame:
    """Nodes, with null totals, and a row of totals for each container, with a null node."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*HEAD, "conv", "depth", "id", "chars", "w")
    rows = rows.repartition(parts, *HEAD).sortWithinPartitions(*HEAD, "conv", "depth")
    schema = f"{NODE}, {TOTAL}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, suffixes, last, out = None, [], None, []

        def close() -> None:
            found, totals = sweep(*held, suffixes)
            out.extend((*row, *[None] * 5) for row in found)
            out.append((*[None] * 8, *totals))

        for batch in batches:
            for head, depth, conv, _, turn, chars, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (head, depth) != held:
                    if held:
                        close()
                    held, suffixes, last = (head, depth), [], None
                if conv != last:
                    suffixes.append(([], [], conv, w))
                    last = conv
                suffixes[-1][0].append(turn)
                suffixes[-1][1].append(chars)
            yield _batch(out, schema)
            out.clear()
        if held:
            close()
        yield _batch(out, schema)

    return rows.mapInArrow(run, schema)


# -- bursting -----------------------------------------------------------------------------


# What a sequence knows of its container: turns, sequences, smallest conversation, weight, longest length.
SIZE = ["turns", "members", "low", "all_w", "most"]


def _burst(turns: DataFrame, big: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Splits containers: their chains (a row a node), the new heads, and the sequences' new containers.

    ``big`` has conv, len, w, the head and the size of the container of each sequence.
    """
    rows = _blocks(big, F.col("head_depth") + 1).join(turns, ["conv", "block"]).where("depth > head_depth")
    rows = materialize(rows, "burst-turns")
    same = [F.min(c).alias(c) for c in SIZE]
    levels = rows.groupBy(*HEAD, "depth").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("chars").alias("chars"),
        F.min(F.when(F.col("len") == F.col("depth"), F.col("conv"))).alias("end_conv"), *same,
    )
    levels = materialize(levels, "burst-levels")
    parted = F.min(F.when((F.col("n") < F.col("members")) | (F.col("lo") != F.col("hi")), F.col("depth")))
    # One sequence alone is all chain.
    cut = levels.groupBy(*HEAD).agg(
        F.coalesce(parted, F.min("most") + 1).alias("cut"), F.count("*").alias("span"), F.min("turns").alias("turns")
    )
    cut = materialize(cut, "burst-cuts")
    chains = levels.select(*HEAD, "depth", "chars", "end_conv", "low", "all_w")
    chains = join_busy(chains, cut.drop("turns"), HEAD, "span").where("depth < cut")
    last = join_busy(rows, cut.select(*HEAD, "cut", F.col("turns").alias("weight")), HEAD, "weight").where("depth = cut")
    above = F.when(F.col("cut") - 1 > F.col("head_depth"), F.col("low")).otherwise(F.col("head"))
    longer = F.col("len") > F.col("cut")
    heads = last.groupBy(*HEAD, "id").agg(
        F.min("conv").alias("conv_id"), F.min("cut").alias("depth"), F.min(above).alias("parent_conv_id"),
        F.sum("w").alias("n_convs"), F.min("chars").alias("chars"), F.min(F.when(~longer, F.col("conv"))).alias("end_conv"),
        F.sum(F.col("len") - F.col("cut")).alias("turns"), F.count_if(longer).alias("members"),
        F.min(F.when(longer, F.col("conv"))).alias("low"), F.sum(F.when(longer, F.col("w"))).alias("all_w"), F.max("len").alias("most"),
    )
    heads = materialize(heads, "burst-heads")
    gone = last.where(longer).select(*HEAD, "id", "conv", "len", "w")
    new = heads.select(*HEAD, "id", "conv_id", "depth", *SIZE, F.col("members").alias("weight"))
    moved = join_busy(gone, new, [*HEAD, "id"], "weight")
    moved = moved.select("conv", "len", "w", F.col("conv_id").alias("head"), F.col("depth").alias("head_depth"), *SIZE)
    return chains, heads, moved


def _chain_nodes(chains: DataFrame, below: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of chains, written with their containers, and the totals of containers.

    ``below`` has, per container, what lies under the chain: children, leaves and saved. Sums along a
    chain are made in blocks of depths and over the blocks. The totals are those of a chain's first node.
    """
    own = (F.col("all_w") - 1) * F.col("chars")
    rows = chains.withColumn("own", own).withColumn("block", block_of(F.col("depth")))
    blocks = rows.groupBy(*HEAD, "block").agg(F.sum("own").alias("of_block"))
    later = Window.partitionBy(*HEAD).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*HEAD, "block", F.coalesce(F.sum("of_block").over(later), F.lit(0)).alias("later"))
    inside = Window.partitionBy(*HEAD, "block").orderBy(F.desc("depth"))
    blocks = blocks.join(below, HEAD, "left")
    rows = rows.join(blocks, [*HEAD, "block"]).withColumn("along", F.col("later") + F.sum("own").over(inside))
    first = F.col("depth") == F.col("head_depth") + 1
    nodes = rows.select(
        *HEAD, F.col("low").alias("conv_id"), "depth", F.when(first, F.col("head")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.col("all_w").alias("n_convs"),
        F.when(F.col("depth") < F.col("cut") - 1, 1).otherwise(F.coalesce("children", F.lit(0))).alias("n_children"),
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        (F.col("along") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"), "end_conv",
    )
    nodes = materialize(nodes, "chain-nodes")
    top = nodes.where(F.col("depth") == F.col("head_depth") + 1).select(
        *HEAD, F.lit(1).cast("bigint").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")
    )
    bare = below.join(top.select(*HEAD), HEAD, "left_anti")
    return nodes, top.unionByName(bare.select(*top.columns))


def _head_nodes(heads: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes at heads, with the container that they belonged to before."""
    under = totals.select(F.col("head").alias("conv_id"), F.col("head_depth").alias("depth"), "children", "leaves", "saved")
    return heads.join(under, ["conv_id", "depth"], "left").select(
        *HEAD, "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"), "end_conv",
    )


def trie_nodes(distinct: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The columns of ``NODE`` for every node."""
    some = _blocks(distinct.where("len > 0"), F.lit(1)).select("conv", "block")
    turns = materialize(turns.join(some, ["conv", "block"], "left_semi"), "trie-turns")
    root = distinct.agg(
        F.min("conv").alias("conv_id"), F.sum("w").alias("n_convs"),
        F.min(F.when(F.col("len") == 0, F.col("conv"))).alias("end_conv"),
    ).where("conv_id IS NOT NULL")
    none = F.lit(None).cast("bigint")
    root = root.select(
        none.alias("head"), none.alias("head_depth"), "conv_id", F.lit(0).cast("bigint").alias("depth"),
        none.alias("parent_conv_id"), "n_convs", F.lit(0).cast("bigint").alias("chars"), "end_conv",
    )
    root = materialize(root, "root")
    state = distinct.where("len > 0")
    size = state.agg(
        F.min("conv").alias("low"), F.sum("w").alias("all_w"), F.sum("len").alias("turns"), F.max("len").alias("most"),
        F.count("*").alias("members"),
    ).first().asDict()
    size |= {"head": (root.first() or {"conv_id": None})["conv_id"], "head_depth": 0}
    state = materialize(state.select("*", *[F.lit(v).cast("bigint").alias(c) for c, v in size.items()]), "containers")
    large = F.col("turns") > limit
    bursts, kept = [], [state.where(~large)]
    while not state.where(large).isEmpty():
        chains, heads, moved = _burst(turns, state.where(large))
        bursts.append((chains, heads))
        state = materialize(moved, "containers")
        kept.append(state.where(~large))
    rest = kept[0]
    for part in kept[1:]:
        rest = rest.unionByName(part)
    rows = _blocks(rest, F.col("head_depth") + 1).join(turns, ["conv", "block"]).where("depth > head_depth")
    found = materialize(swept(rows), "swept")
    names = [f.split()[0] for f in NODE.split(", ")]
    nodes = [found.where("conv_id IS NOT NULL").select(*names)]
    totals = found.where("conv_id IS NULL").select(*[f.split()[0] for f in TOTAL.split(", ")])
    for chains, heads in reversed(bursts):
        heads = materialize(_head_nodes(heads, totals), "head-nodes")
        nodes.append(heads.select(*names))
        below = heads.groupBy(*HEAD).agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        chain, more = _chain_nodes(chains, below)
        nodes.append(chain)
        totals = totals.unionByName(materialize(more, "container-totals"))
    nodes.append(_head_nodes(root, totals).select(*names))
    out = nodes[0]
    for part in nodes[1:]:
        out = out.unionByName(part.select(*[F.col(c).cast("bigint") for c in names]))
    return out


def prefix_trie(
    conversations: DataFrame,
    limit: int = LIMIT,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    prepared(conversations.sparkSession)
    convs, turns = rebuilt(turn_rows(conversations, id_col, turn_col, role_col, text_col))
    keys, distinct = sequences(convs, turns)
    nodes = materialize(trie_nodes(distinct, turns, limit), "nodes")
    named = nodes.join(end_digests(keys), "end_conv", "left").drop("end_conv")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return named.withColumn("ends_sha256", F.coalesce("ends_sha256", empty))
