"""Exact positions of rows in an order, without bringing a key's rows into one task.

Rows are dealt out by ranges of the whole order, so a busy key lies in many ranges. Counts per key and
range, summed over the earlier ranges of the key, turn a position within a range into one within the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierlake.session import materialize

SLOT = "slot"


def in_ranges(rows: DataFrame, order: Sequence[str], purpose: str = "ranges") -> DataFrame:
    """The rows, written, with the number of their range in ``slot``; nulls come first.

    Rows that agree in the whole order may be in several ranges that follow each other.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrival = "arrival_"
    placed = rows.withColumn(arrival, F.monotonically_increasing_id())
    placed = placed.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order], arrival)
    return materialize(placed.drop(arrival).withColumn(SLOT, F.spark_partition_id()), purpose)


def runs(placed: DataFrame, key: Sequence[str], weight: str | None = None) -> DataFrame:
    """Per key and range: rows ``n``, and ``before``, those of the key in earlier ranges.

    A key has one row for each range that it lies in. With a ``weight`` both add it up instead.
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counted = placed.groupBy(*key, SLOT).agg(total.alias("n"))
    earlier = Window.partitionBy(*key).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def place(placed: DataFrame, of: DataFrame, key: Sequence[str], order: Sequence[str], name: str, weight: str | None = None) -> DataFrame:
    """Adds the position in the key, from 1, and the columns that ``of``, made by ``runs``, has beside n and before.

    With a ``weight`` the position is 1 more than the weight of the rows before.
    """
    match, names = None, [*key, SLOT]
    other = of.select(
        *[F.col(c).alias(f"{c}_of") for c in names], *[c for c in of.columns if c not in [*names, "n"]]
    )
    for c in names:
        same = placed[c].eqNullSafe(other[f"{c}_of"])
        match = same if match is None else match & same
    joined = placed.join(other, match).drop(*[f"{c}_of" for c in names])
    at = _within(names, order, weight)
    return joined.withColumn(name, F.col("before") + at).drop("before", SLOT)


def _within(key: Sequence[str], order: Sequence[str], weight: str | None) -> Column:
    inside = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    if weight is None:
        return F.row_number().over(inside)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(weight).over(earlier), F.lit(0)) + 1


def positioned(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "position", weight: str | None = None
) -> DataFrame:
    """``numbered`` for keys whose rows may lie in one task."""
    return rows.withColumn(name, _within(key, order, weight))


def numbered(
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    weight: str | None = None,
) -> DataFrame:
    """Adds the position of each row among those of its key, from 1; ties count in any order."""
    placed = in_ranges(rows, [*key, *order])
    return place(placed, runs(placed, key, weight), key, order, name, weight)
