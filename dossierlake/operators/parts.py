"""Gathering the rows of a key into arrays, in pages of bounded length."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.functions.keys import join_key
from dossierlake.operators.numbering import numbered, positioned
from dossierlake.session import materialize

# Items of a key from which on it is ranked in ranges.
BUSY_ITEMS = 100_000
# Rows of a task where the number of tasks follows that of the rows.
TASK_ROWS = 400_000
# Pages of a key that may lie in one task, where that is not less than a page of the usual length.
FULL_PAGES = 10
# Items of a page, unless the caller states another length or a number of pages.
PAGE_ITEMS = 1000


def tasks_for(spark: SparkSession, rows: int, each: int = TASK_ROWS) -> int:
    """Tasks for so many rows: at least the session's number, so that a task's share stays bounded."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


@dataclass
class Dealing:
    """How rows are dealt out by a key: in so many tasks, the rows of a key together unless it is busy."""

    key: list[str]
    tasks: int
    # Digests of the busy keys, if there are any; a key that shares one counts as busy, too.
    busy: DataFrame | None

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows of other keys, dealt out, and those of busy ones as they lie."""
        if self.busy is None:
            return self.deal(rows), None
        same = F.xxhash64(*self.key) == self.busy["key_"]
        calm, busy = (rows.join(F.broadcast(self.busy), same, how) for how in ("left_anti", "left_semi"))
        return self.deal(calm), busy

    def deal(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.tasks, *self.key)


def dealing(rows: DataFrame, key: list[str], most: int = BUSY_ITEMS) -> Dealing:
    """Counts written rows and finds the keys with more than ``most`` of them."""
    sizes = rows.groupBy(F.xxhash64(*key).alias("key_")).agg(F.count(F.lit(1)).alias("rows_"))
    # At most one row for every ``most`` rows.
    busy = materialize(sizes.where(F.col("rows_") > most).select("key_"), "busy")
    return Dealing(key, tasks_for(rows.sparkSession, rows.count()), None if busy.isEmpty() else busy)


def page_of(pages: int | Column, *items: str) -> Column:
    """Page of an item, from a digest of its text: 0 to pages - 1.

    The caller states the number of pages; it never follows from the data, so a key's page does
    not move when other rows come or go. With more pages a busy key is spread over more groups.
    """
    digest = F.md5(join_key(*[F.col(i).cast("string") for i in items]))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (number % F.lit(pages)).cast("int")


def busy_from(length: int) -> int:
    """Items of a key from which on it is ranked in ranges: some full pages, so that these lie in several tasks."""
    return min(BUSY_ITEMS, max(PAGE_ITEMS, FULL_PAGES * length))


def with_page(
    rows: DataFrame,
    key: list[str],
    identity: list[str],
    pages: int | None = None,
    length: int = PAGE_ITEMS,
    weight: str | None = None,
    calm: bool = False,
) -> DataFrame:
    """Adds ``page``: by digest with a stated number of pages, else by exact rank, ``length`` items each.

    Keys of few pages, and of at most ``BUSY_ITEMS`` items, are ranked where ``gather`` brings them together anyway. Ranks of
    others come from ranges of the sorted items, so a busy key lies in many tasks. No page is longer than
    stated. An item with a ``weight`` counts as so many. ``calm`` states that no key is busy.
    """
    if pages is not None:
        return rows.withColumn("page", page_of(pages, *identity))
    if calm:
        return _paged(positioned(rows, key, identity, "rank_", weight), length)
    rows = materialize(rows, "items")
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("items_")).where(F.col("items_") > busy_from(length))
    # At most one row for so many items.
    busy = materialize(sizes.select(*[F.col(c).alias(f"{c}_of") for c in key]), "busy")
    if busy.isEmpty():
        placed = positioned(rows, key, identity, "rank_", weight)
    else:
        same = reduce(Column.__and__, [rows[c].eqNullSafe(busy[f"{c}_of"]) for c in key])
        placed = positioned(rows.join(busy, same, "left_anti"), key, identity, "rank_", weight)
        ranged = numbered(rows.join(busy, same, "left_semi"), key, identity, "rank_", weight)
        placed = placed.unionByName(ranged)
    return _paged(placed, length)


def _paged(ranked: DataFrame, length: int) -> DataFrame:
    return ranked.withColumn("page", F.floor((F.col("rank_") - 1) / length).cast("int")).drop("rank_")


def gather(
    rows: DataFrame,
    key: list[str],
    item: Column,
    name: str,
    identity: list[str],
    pages: int | None = None,
    length: int = PAGE_ITEMS,
    weight: str | None = None,
    calm: bool = False,
) -> DataFrame:
    """Sorted array of ``item`` per key and page."""
    return (
        with_page(rows, key, identity, pages, length, weight, calm)
        .groupBy(*key, "page")
        .agg(F.sort_array(F.collect_list(item)).alias(name))
    )
