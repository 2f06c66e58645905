"""The profile fold.

Two day-level tables carry everything and are the only state that is ever merged:

* ``attr_day``   - row key, code, value, day: n, first_time, last_time, latest, arrival
* ``entity_day`` - entity, day: n, first_time, last_time

Each measure is a count, minimum or maximum, so folding a batch, merging two batches
and folding a stream are the same aggregation. Every aggregate buffer is a fixed-width
number, which keeps the day folds on hash aggregation with map-side partials: a key that
holds a third of the input reaches the shuffle as one row per map task and day. Histograms
and the latest values of info profiles hold lists and structs and are sort aggregations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierlake.dictionary import MULTI, AttrDictionary
from dossierlake.functions.times import day_number
from dossierlake.operators.attributes import DAY, SLOT, near, with_fold_kind
from dossierlake.schema import ATTR_KEY, ENTITY

ATTR_DAY_KEY = ATTR_KEY + ["day"]
ENTITY_DAY_KEY = ENTITY + ["day"]
ATTR_DAY = ATTR_DAY_KEY + ["n", "first_time", "last_time", "latest", "arrival"]
ENTITY_DAY = ENTITY_DAY_KEY + ["n", "first_time", "last_time"]

# Room for the parts of a packed rank: a time within 5 * 10^12 seconds of 1970, an arrival
# number from 0 to 10^19 and a position inside the record below 10^6. Other values are errors.
TIME_ROOM = 10**13
TIME_BIAS = TIME_ROOM // 2
SEQ_ROOM = 10**19
POS_ROOM = 10**6


def _whole(value: Column, digits: int) -> Column:
    return value.cast(f"decimal({digits},0)")


def _power(value: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({len(str(value))},0)")


def _checked(name: str, least: int, end: int | None = None) -> Column:
    """The column, or an error where a value has no room in a rank."""
    value = F.col(name)
    wrong = F.raise_error(F.concat(F.lit(f"{name} out of range: "), value.cast("string")))
    outside = value < least
    if end is not None:
        outside = outside | (value >= end)
    return F.when(outside, wrong.cast("bigint")).otherwise(value)


def latest_rank() -> Column:
    """Orders values of a single code: time, then earlier arrival, then later position."""
    return (
        _whole(_checked("capture_time", -TIME_BIAS, TIME_BIAS), 13) * _power(SEQ_ROOM * POS_ROOM)
        - _whole(_checked("seq", 0), 19) * _power(POS_ROOM)
        + _checked("pos", 0, POS_ROOM)
    ).cast("decimal(38,0)")


def rank_time(rank: Column) -> Column:
    """The time in a ``latest`` rank."""
    room = SEQ_ROOM * POS_ROOM
    shifted = rank + _whole(F.lit(str(TIME_BIAS * room - POS_ROOM)), 38)
    return F.call_function("div", shifted, _power(room)) + F.lit(1 - TIME_BIAS)


def arrival_rank() -> Column:
    """Orders by arrival and carries the time of that arrival in its last digits."""
    return (
        _whole(F.col("seq"), 19) * _power(TIME_ROOM)
        + (F.col("capture_time") + F.lit(TIME_BIAS))
    ).cast("decimal(38,0)")


def arrival_time(rank: Column) -> Column:
    return F.pmod(rank, _power(TIME_ROOM)).cast("bigint") - F.lit(TIME_BIAS)


def attr_day_rows(attrs: DataFrame) -> DataFrame:
    """Rows of ``attr_day`` that each attribute row contributes; merging them is the fold."""
    return _ranked(attrs).select(
        *ATTR_DAY_KEY, F.lit(1).cast("bigint").alias("n"), F.col("capture_time").alias("first_time"),
        F.col("capture_time").alias("last_time"), "latest", "arrival",
    )


def entity_day_rows(obs: DataFrame) -> DataFrame:
    """Rows of ``entity_day`` that each observation contributes."""
    return obs.select(
        *ENTITY, day_number(F.col("capture_time")).alias("day"), F.lit(1).cast("bigint").alias("n"),
        F.col("capture_time").alias("first_time"), F.col("capture_time").alias("last_time"),
    )


def _ranked(attrs: DataFrame) -> DataFrame:
    day = F.col(DAY) if DAY in attrs.columns else day_number(F.col("capture_time"))
    return attrs.select(
        *ATTR_KEY,
        *slot_in(attrs),
        day.alias("day"),
        "capture_time",
        latest_rank().alias("latest"),
        arrival_rank().alias("arrival"),
    )


def slot_in(rows: DataFrame) -> list[str]:
    """The slot of rows that ``placing`` has dealt out; they are folded there and keep it."""
    return [SLOT] if SLOT in rows.columns else []


def fold_attr_day(attrs: DataFrame) -> DataFrame:
    return _ranked(attrs).groupBy(*ATTR_DAY_KEY, *slot_in(attrs)).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("capture_time").alias("first_time"),
        F.max("capture_time").alias("last_time"),
        F.max("latest").alias("latest"),
        F.max("arrival").alias("arrival"),
    )


def fold_entity_day(obs: DataFrame) -> DataFrame:
    return (
        obs.select(*ENTITY, *slot_in(obs), day_number(F.col("capture_time")).alias("day"), "capture_time")
        .groupBy(*ENTITY_DAY_KEY, *slot_in(obs))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("capture_time").alias("first_time"),
            F.max("capture_time").alias("last_time"),
        )
    )


def _union(parts: tuple[DataFrame, ...], columns: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def merge_attr_day(*parts: DataFrame, by: list[str] | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Day tables folded into one; ``by`` deals them out by fewer columns than their key.

    Columns that follow from the key may stay in the rows (``also``).

    By ``ATTR_KEY`` a value's days stay together, so its base profile needs no second shuffle;
    it has at most one row per day in each segment, however busy it is.
    """
    rows = _union(parts, [*ATTR_DAY, *also])
    return (
        (rows.repartition(*near(by)) if by else rows)
        .groupBy(*ATTR_DAY_KEY, *also)
        .agg(
            F.sum("n").alias("n"),
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
            F.max("latest").alias("latest"),
            F.max("arrival").alias("arrival"),
        )
    )


def merge_entity_day(*parts: DataFrame) -> DataFrame:
    return (
        _union(parts, ENTITY_DAY)
        .groupBy(*ENTITY_DAY_KEY)
        .agg(
            F.sum("n").alias("n"),
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
        )
    )


def base_counters(attrs: DataFrame) -> DataFrame:
    """Count, first and last time per attribute value, without the histogram."""
    return attrs.groupBy(*ATTR_KEY).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("capture_time").alias("first_time"),
        F.max("capture_time").alias("last_time"),
    )


def _summary(day_table: DataFrame, key: list[str]) -> DataFrame:
    # At most one entry per calendar day reaches collect_list.
    return day_table.groupBy(*key).agg(
        F.sum("n").alias("cnt"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.count("day").cast("int").alias("day_cnt"),
        F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("days"),
    )


def base_profile(attr_day: DataFrame, placed: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """``profile_base`` from a day table with one row per key and day.

    Rows are dealt out before they are gathered, since histograms of parts would be no smaller;
    ``placed`` states that they lie by ``ATTR_KEY`` already. ``also`` is that of ``merge_attr_day``.
    """
    rows = attr_day.select(*ATTR_DAY_KEY, *also, "n", "first_time", "last_time")
    return _summary(rows if placed else rows.repartition(*near(ATTR_KEY)), [*ATTR_KEY, *also])


def info_profile(entity_day: DataFrame) -> DataFrame:
    """``profile_info`` from a day table with one row per entity and day."""
    return _summary(entity_day, ENTITY)


def info_attributes(attr_day: DataFrame, dictionary: AttrDictionary) -> DataFrame:
    """``profile_info_attr``: latest value of single codes, all values of multi codes.

    The rows of an entity's value are brought together first, in numbers only, which is a hash
    aggregation; the value itself is compared among those few rows. The group of a multi code
    includes its value, the group of a single code does not. Partial and repeated day rows
    are fine here, because only maxima are taken.
    """
    # A row's last time goes along as its distance to the time in its rank, which is a part of the key.
    marked = with_fold_kind(attr_day, dictionary).withColumn("gap", F.col("last_time") - rank_time(F.col("latest")))
    values = marked.groupBy(*ENTITY, "code", "kind", "value", "gap").agg(
        F.max("latest").alias("latest"), F.max("last_time").alias("last_time"), F.max("arrival").alias("arrival")
    )
    slot = F.when(F.col("kind") == MULTI, F.col("value")).otherwise(F.lit(""))
    best = values.groupBy(*ENTITY, "code", "kind", slot.alias("slot")).agg(
        F.max(F.struct("latest", "value", "last_time")).alias("best"),
        F.max("arrival").alias("arrival"),
    )
    return best.select(
        *ENTITY,
        "code",
        "kind",
        "best.value",
        "best.last_time",
        F.when(F.col("kind") == MULTI, arrival_time(F.col("arrival")))
        .otherwise(F.col("best.last_time"))
        .alias("last_arrival_time"),
    )


def latest_by_window(attrs: DataFrame) -> DataFrame:
    """Latest value of every (entity, code) as a ranking window.

    Spark cuts each group to its first row before the shuffle (window group limit), so
    a hot code does not travel whole.
    """
    order = Window.partitionBy(*ENTITY, "code").orderBy(
        F.desc("capture_time"), F.asc("seq"), F.desc("pos"), F.desc("value")
    )
    return (
        attrs.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") == 1)
        .select(*ENTITY, "code", "value", F.col("capture_time").alias("last_time"))
    )


def days_text(days: Column) -> Column:
    """Day histogram as sorted text ``yyyymmdd:n,...``."""
    entries = F.array_sort(F.map_entries(days))
    return F.array_join(
        F.transform(
            entries,
            lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string")),
        ),
        ",",
    )
