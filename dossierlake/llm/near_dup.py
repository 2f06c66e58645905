"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is its distinct five-word windows, each with the weight 1 + ln(times it occurs). Each
window is a Poisson process whose rate is its weight; its arrivals fall into random registers, and a
register keeps the window that came first. A window stops as soon as its next arrival is later than
every register's first. Two documents agree in a register with probability J_P, their probability
Jaccard similarity. Registers are joined to bands; documents that share a band are candidates.

Verification computes J_P itself. Each document is compared with its pivot, the smallest id that
heads one of its buckets; links give first classes. In a bucket of at most ``FEW`` documents all pairs of
different classes are compared, unless both have one pivot and their distances to it differ by more than the
allowed distance: 1 - J_P is a metric. Larger buckets with one head become one group, which is split by what
its documents have besides the windows that are common there, held by at least one in ``COMMON`` of some members. If A is the
weight of a document and A' that of the windows that it shares with another, J_P is at most
1 / (A / A' + B / B' - 1). A document is *far* if this bound rules out every partner that shares nothing but
common windows with it; such a document has links only inside the groups of its other windows. So these
become groups of the next round. Each is smaller, since a window that all members hold is common. Documents that are not far stay and are
compared with leaders of the other classes, the most central ones; leaders then leave their group. Rounds
go on until no group holds several classes, with ``GROWTH`` times as many leaders up to ``MOST_LEADERS``, later
ones whatever their class. So every link that shares a band is found. Rows grow with documents times their
windows; only documents of a group that are not far and yet not near each other still meet pair by pair.
``leaders=None`` compares all pairs of different classes of a bucket at once.

Classes are the components of exact copies and links, named by their smallest id. Components are
found by large-star and small-star steps on the edge table, written to the shared folder each time.

Null text: a class of its own. Empty or blank texts: copies only of equal texts. Fewer than five
words: one window of all words. Repeated rows (same id and text): one class, as copies. Rows with
one null id: a class named null. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossierlake.llm.frames import flat_bytes, prepared, slices
from dossierlake.llm.words import mix, powers, spans, window_hashes, word_hashes
from dossierlake.session import materialize

WIDTH = 5
SIMILARITY = 0.8
LIMIT = 1 - SIMILARITY + 1e-12
# A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 25 = 5e-5.
BANDS = 25
BAND_ROWS = 5
SLICE = 1 << 20
# Documents of a bucket that are compared in pairs, and the share of a group that holds a common window.
FEW = 32
COMMON = 8
# Members of a group, chosen by their hash, that say which windows are common.
SEEN = 64
# Leaders of a group that holds several classes, in the first round; later rounds have more.
LEADERS = 8
GROWTH = 8
MOST_LEADERS = 512

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and weight of every distinct window, ordered by row."""
    starts, ends, rows = spans(data, offsets)
    words = word_hashes(data, starts, ends)
    keys, first = window_hashes(words, rows, WIDTH)
    of = rows[first]
    count = np.bincount(rows, minlength=len(offsets) - 1)
    few = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(few):
        begin = np.cumsum(count) - count
        whole = np.zeros(len(few), np.uint64)
        for i in range(WIDTH - 1):
            has = count[few] > i
            whole[has] += words[begin[few][has] + i] * powers(WIDTH)[i]
        keys = np.concatenate([keys, mix(whole ^ np.uint64(1))])
        of = np.concatenate([of, few])
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    if not len(keys):
        return of, keys, np.zeros(0)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(keys)))
    return of[at], keys[at], 1.0 + np.log(times)


def signatures(of: np.ndarray, keys: np.ndarray, weights: np.ndarray, n_rows: int) -> np.ndarray:
    """The window that comes first in each register of each row; 0 for rows without windows."""
    m = BANDS * BAND_ROWS
    first = np.full(n_rows * m, np.inf)
    owner = np.zeros(n_rows * m, np.uint64)
    time = np.zeros(len(keys))
    active = np.arange(len(keys))
    arrival = 0
    while len(active):
        arrival += 1
        draw = mix(keys[active] + np.uint64(arrival * int(_GOLD) & (1 << 64) - 1))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weights[active]
        register = (mix(draw) >> np.uint64(32)).astype(np.int64) * m >> 32
        register += of[active] * m
        better = np.flatnonzero(time < first[register])
        at, when, who = register[better], time[better], keys[active[better]]
        order = np.lexsort((who, when))[::-1]  # the earliest is written last
        first[at[order]] = when[order]
        owner[at[order]] = who[order]
        last = first.reshape(n_rows, m).max(1)
        going = time < last[of[active]]
        active, time = active[going], time[going]
    return owner.reshape(n_rows, m)


def band_keys(sign: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = sign.reshape(len(sign), BANDS, BAND_ROWS)
    keys = np.zeros((len(sign), BANDS), np.uint64)
    for i in range(BAND_ROWS):
        keys = mix(keys + parts[:, :, i])
    return mix(keys + np.arange(BANDS, dtype=np.uint64) * _GOLD).view(np.int64)


def similarity(ka: np.ndarray, wa: np.ndarray, kb: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets, given by ascending keys."""
    keys = np.union1d(ka, kb)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, ka)] = wa
    y[np.searchsorted(keys, kb)] = wb
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # For a common window with ratio r: sum x over ratios up to r, and y over the others.
    upto = np.searchsorted(ratio, ratio, "right")
    low = np.concatenate([[0], np.cumsum(x)])[upto]
    high = y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]
    both = (x > 0) & (y > 0)
    return float((1 / (low[both] / x[both] + np.maximum(high[both], 0) / y[both])).sum())


def sketch(docs: DataFrame) -> DataFrame:
    """doc, text digest and band keys (none without words) of columns doc and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(2))
            for a, b in slices(offsets, SLICE):
                of, keys, weights = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n = b - a
                found = band_keys(signatures(of, keys, weights, n))
                has = np.bincount(of, minlength=n) > 0
                ends = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[has].ravel()))
                columns = [batch.column(0).slice(a, n), batch.column(1).slice(a, n), bands]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "digest", "bands"])

    rows = docs.select("doc", "digest", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc bigint, digest string, bands array<bigint>")


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds the distance 1 - J_P to pairs (a, b); ``texts`` has doc and text of all of them."""
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    # b may stand in very many pairs: it is joined last, between plain shuffles that may be split.
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        for batch in batches:
            a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for i in range(len(a)):
                if held[0] != b[i]:
                    held = (b[i], _weighted(tb[i]))
                out.append(1.0 - similarity(*_weighted(ta[i]), *held[1]))
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "distance"])

    return joined.mapInArrow(run, "a bigint, b bigint, distance double")


def _weighted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    _, keys, weights = shingles(data, np.array([0, len(data)]))
    return keys, weights


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """doc and the smallest id of its component, for all ids of edges (a, b)."""
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    pairs = materialize(pairs, "edges")
    while True:
        # Large star: larger neighbours go to the smallest of the neighbours and the node itself.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = materialize(moved.where("u <> v").distinct(), "large-star")
        # Small star: the node and its smaller neighbours go to the smallest of them.
        least = materialize(moved.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = moved.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = materialize(pairs, "small-star")
        # Done when every node has one edge, and that to a node without one.
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(pairs.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if open_.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
    # A root has a row as well.
    roots = pairs.select("v").distinct().select(F.col("v").alias("doc"), F.col("v").alias("class"))
    return pairs.select(F.col("u").alias("doc"), F.col("v").alias("class")).unionByName(roots)


def classes(docs: DataFrame, leaders: int | None = LEADERS) -> DataFrame:
    """doc, digest and class of every row of columns doc, digest and text.

    Equal digests are one document here, named by their smallest id. Different texts of one id are
    one class; the smallest digest stands for them in comparisons.
    """
    spark = prepared(docs.sparkSession)
    rows = materialize(sketch(docs), "sketches")
    copies = rows.where("digest IS NOT NULL AND doc IS NOT NULL").groupBy("digest")
    copies = copies.agg(F.min(F.struct("doc", "bands")).alias("kept"))
    copies = copies.select("digest", F.col("kept.doc").alias("first"), "kept.bands")
    copies = materialize(copies, "distinct")
    # A node is the first id of a text; should an id have several texts, one stands for them.
    nodes = copies.groupBy("first").agg(F.min(F.struct("digest", "bands")).alias("kept"))
    nodes = nodes.select("first", F.col("kept.digest").alias("digest"), "kept.bands")
    nodes = materialize(nodes, "nodes")
    buckets = nodes.select("first", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("first").alias("head"), F.count("*").alias("n"))
    heads = materialize(heads.where("n > 1"), "buckets")
    members = materialize(buckets.join(heads, "bucket"), "members")
    # A document's pivot: the smallest head of its buckets. Its reach: what its buckets hold.
    pivots = members.groupBy("first").agg(F.min("head").alias("pivot"), F.sum("n").alias("reach"))
    pivots = materialize(pivots, "pivots")
    wanted = nodes.join(pivots, "first").select(F.col("first").alias("doc"), "digest")
    texts = docs.join(materialize(wanted, "wanted").hint("merge"), ["doc", "digest"], "left_semi")
    texts = texts.select("doc", F.col("text").cast("binary").alias("text")).dropDuplicates(["doc"])
    texts = materialize(texts, "candidate-texts")

    pairs = pivots.where("first <> pivot").select(F.col("first").alias("a"), F.col("pivot").alias("b"))
    near = materialize(compare(pairs, texts), "to-pivots")
    links = _links(near)
    found = materialize(components(spark, links), "classes")
    placed = pivots.join(near.select(F.col("a").alias("first"), "distance"), "first", "left")
    members = members.join(placed.withColumn("d", F.coalesce("distance", F.lit(0.0))).drop("distance"), "first")
    members = materialize(members.drop("head"), "placed")
    if leaders is not None:
        # Large buckets whose smallest pivot is the same are one group.
        large = members.where(F.col("n") > FEW)
        named = large.groupBy("bucket").agg(F.xxhash64(F.lit("group"), F.min("pivot")).alias("group"))
        large = large.join(named, "bucket").withColumn("bucket", F.col("group")).drop("group")
        large = large.dropDuplicates(["bucket", "first"])
        members = materialize(members.where(F.col("n") <= FEW).unionByName(large), "groups")
    members = members.drop("n")

    size, one_a_class, grams = leaders, True, None
    while True:
        members = _classed(members, found)
        if members.isEmpty():
            break
        if leaders is None:
            last = materialize(_links(compare(materialize(_all_pairs(members), "pairs"), texts)), "links")
            found = materialize(components(spark, links.unionByName(last)), "classes")
            break
        few = members.where(F.col("n") <= FEW)
        pairs = _with_leaders(few, _leaders(few, FEW, False))
        many = members.where(F.col("n") > FEW)
        rest = None
        if not many.isEmpty():
            if grams is None:
                wanted = many.select(F.col("first").alias("doc")).distinct()
                grams = materialize(windows(texts.join(wanted, "doc", "left_semi")), "windows")
            inner, split = _parted(many, grams)
            heads = materialize(_leaders(_outsiders(inner), size, one_a_class), "leaders")
            pairs = pairs.unionByName(_with_leaders(inner, heads)).distinct()
            led = heads.select("bucket", F.col("first_").alias("first"))
            rest = inner.join(led, ["bucket", "first"], "left_anti").select(*split.columns).unionByName(split)
        last = materialize(_links(compare(materialize(pairs, "leader-candidates"), texts)), "links")
        if not last.isEmpty():
            links = materialize(links.unionByName(last), "links")
            found = materialize(components(spark, links), "classes")
        if rest is None:
            break
        members = materialize(rest, "rest")
        size, one_a_class = max(size, min(size * GROWTH, MOST_LEADERS)), False

    named = copies.join(found, copies["first"] == found["doc"], "left")
    named = named.select("digest", F.coalesce("class", "first").alias("class"))
    named = materialize(named, "digest-classes")
    return rows.select("doc", "digest").join(named, "digest", "left").select(
        "doc", "digest", F.coalesce("class", "doc").alias("class")
    )


def _links(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("distance") <= LIMIT).select("a", "b")


def _classed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes, with their class and the bucket's size."""
    placed = members.join(found.withColumnRenamed("doc", "first"), "first", "left")
    placed = materialize(placed.withColumn("class", F.coalesce("class", "first")), "classed")
    several = placed.groupBy("bucket").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n")
    )
    several = several.where("low <> high").select("bucket", "n")
    return materialize(placed.join(several, "bucket"), "open")


def windows(texts: DataFrame) -> DataFrame:
    """doc and its distinct windows, a list of key and weight, of columns doc and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(1))
            for a, b in slices(offsets, SLICE):
                of, keys, weights = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(keys.view(np.int64)), pa.array(weights)], ["key", "weight"])
                columns = [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pairs)]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "windows"])

    return texts.select("doc", "text").mapInArrow(run, "doc bigint, windows array<struct<key:bigint,weight:double>>")


def _outsiders(inner: DataFrame) -> DataFrame:
    """Members of the largest class of a group come after all others when leaders are chosen."""
    sizes = inner.groupBy("bucket", "class").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("size", "class")).alias("top")).select("bucket", "top.class")
    marked = inner.join(largest.withColumnRenamed("class", "largest"), "bucket")
    return marked.withColumn("reach", F.col("reach") - F.when(F.col("class") == F.col("largest"), 1 << 40).otherwise(0)).drop("largest")


def _common(many: DataFrame, grams: DataFrame) -> DataFrame:
    """A list of the common windows of each group: those that one in ``COMMON`` of ``SEEN`` members holds.

    Which windows count as common decides how groups are split, never which links are found.
    """
    seen = Window.partitionBy("bucket").orderBy(F.xxhash64("first"), "first")
    some = many.select("bucket", "first", F.least("n", F.lit(SEEN)).alias("n"), F.row_number().over(seen).alias("rank"))
    some = some.where(F.col("rank") <= SEEN)
    terms = some.join(grams.withColumnRenamed("doc", "first"), "first").select("bucket", "n", F.inline("windows"))
    held = terms.groupBy("bucket", "key", "n").agg(F.count("*").alias("held")).where(F.col("held") * COMMON >= F.col("n"))
    return materialize(held.groupBy("bucket").agg(F.sort_array(F.collect_list("key")).alias("common")), "common")


def _apart(rows: DataFrame) -> DataFrame:
    """Weight and number of a member's windows and of its common ones, and the keys of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for held, common in zip(batch.column(3), batch.column(4), strict=True):
                keys = held.values.field("key").to_numpy()
                weights = held.values.field("weight").to_numpy()
                inside = np.isin(keys, common.values.to_numpy()) if common.is_valid else np.zeros(len(keys), bool)
                row = [weights.sum(), len(keys), weights[inside].sum(), inside.sum(), keys[~inside]]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.float64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names)

    schema = "bucket bigint, first bigint, class bigint, all_w double, all_n bigint, common_w double, common_n bigint, others array<bigint>"
    names = [f.split()[0] for f in schema.split(", ")]
    return rows.select("bucket", "first", "class", "windows", "common").mapInArrow(run, schema)


def _parted(many: DataFrame, grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members that are not far, with their share of common windows as reach, and the groups by other windows."""
    placed = many.select("bucket", "first", "class").join(grams.withColumnRenamed("doc", "first"), "first")
    own = _apart(placed.join(_common(many, grams), "bucket", "left")).withColumn("extra", F.col("all_w") - F.col("all_n"))
    own = materialize(own, "weights")
    sizes = own.groupBy("bucket").agg(F.collect_set("all_n").alias("sizes"), F.max("extra").alias("most_extra"))
    # A partner holds at least the shared weight; of those the smallest has the largest bound.
    least = F.array_min(F.filter("sizes", lambda x: x >= F.col("all_w") * SIMILARITY - F.col("extra") - 1e-9))
    theirs = (least + F.col("most_extra")) / (F.col("common_n") + F.col("most_extra"))
    need = F.col("all_w") / F.col("common_w") + F.greatest(theirs, F.lit(1.0))
    far = F.when(F.col("common_n") == 0, True).otherwise(need > 1 / SIMILARITY + 1 + 1e-9)
    central = (F.col("common_w") / F.col("all_w") * 1e9).cast("bigint")
    own = own.join(sizes, "bucket").select("bucket", "first", "class", "others", far.alias("far"), central.alias("central"))
    own = materialize(own, "far")
    inner = many.join(own.where("NOT far").select("bucket", "first", "central"), ["bucket", "first"])
    inner = materialize(inner.drop("reach").withColumnRenamed("central", "reach"), "inner")
    # Of windows with the same holders one makes a group; without a far one they are compared already.
    other = own.select("bucket", "first", "class", "far", F.explode("others").alias("key"))
    other = materialize(other, "other-windows")
    groups = other.groupBy("bucket", "key").agg(
        F.bit_xor(F.xxhash64("first")).alias("who"), F.bit_xor(F.xxhash64(F.lit(1), "first")).alias("who_too"),
        F.count("*").alias("holders"), F.min("class").alias("low"), F.max("class").alias("high"), F.max("far").alias("far"),
    )
    groups = groups.where("far AND low <> high").groupBy("who", "who_too", "holders").agg(F.min(F.struct("bucket", "key")).alias("at"))
    split = other.join(groups.select("at.bucket", "at.key").hint("merge"), ["bucket", "key"], "left_semi")
    split = split.select(F.xxhash64("bucket", "key").alias("bucket"), "first").distinct()
    kept = many.select("first", "pivot", "reach", "d").dropDuplicates(["first"])
    return inner, split.join(kept, "first").select("bucket", "first", "pivot", "reach", "d")


def _all_pairs(open_: DataFrame) -> DataFrame:
    """Pairs of members of different classes of a bucket that may be linked."""
    heads = open_.select("bucket", *[F.col(c).alias(f"{c}_") for c in ("class", "first", "pivot", "d")])
    pairs = open_.join(heads, "bucket").where(_may_be_linked(F.col))
    return pairs.select(F.col("first").alias("a"), F.col("first_").alias("b")).distinct()


def _leaders(open_: DataFrame, size: int, one_a_class: bool) -> DataFrame:
    """At most ``size`` leaders of each bucket, in columns that end with a line."""
    entry = F.struct("reach", (-F.col("first")).alias("minus"), "pivot", "d")
    heads = open_.select("bucket", "class", entry.alias("top"))
    if one_a_class:
        heads = heads.groupBy("bucket", "class").agg(F.max("top").alias("top"))
    order = Window.partitionBy("bucket").orderBy(F.desc("top"))
    heads = heads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return heads.select(
        "bucket", F.col("class").alias("class_"), (-F.col("top.minus")).alias("first_"),
        F.col("top.pivot").alias("pivot_"), F.col("top.d").alias("d_"),
    )


def _with_leaders(open_: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs of a member and a leader of another class of its bucket that may be linked."""
    heads = heads.groupBy("bucket").agg(F.collect_list(F.struct("class_", "first_", "pivot_", "d_")).alias("leaders"))
    # A member meets the same leaders in many buckets: its leaders are brought together before pairs are made.
    # Two leaders of a bucket meet once.
    leads = F.exists("leaders", lambda x: x["first_"] == F.col("first"))
    found = F.filter(
        "leaders",
        lambda x: _may_be_linked(lambda c: x[c] if c.endswith("_") else F.col(c)) & (~F.col("leads") | (x["first_"] < F.col("first"))),
    )
    met = open_.join(heads, "bucket").withColumn("leads", leads).select("first", F.transform(found, lambda x: x["first_"]).alias("met"))
    met = met.groupBy("first").agg(F.array_distinct(F.flatten(F.collect_list("met"))).alias("met"))
    return met.select(F.col("first").alias("a"), F.explode("met").alias("b"))


def _may_be_linked(column: Callable[[str], Column]) -> Column:
    """Whether a member and a leader (names with a line at the end) are apart, not compared and not ruled out."""
    first = (column("class") != column("class_")) & (column("pivot") != column("first_")) & (column("pivot_") != column("first"))
    near = F.abs(column("d") - column("d_")) <= LIMIT
    return first & ((column("pivot") != column("pivot_")) | near)


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaders: int | None = LEADERS
) -> DataFrame:
    """doc_id and class_id of every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), text_digest(text).alias("digest"), text.alias("text")
    )
    return classes(rows, leaders).select(F.col("doc").alias("doc_id"), F.col("class").alias("class_id"))
