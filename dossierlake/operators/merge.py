"""Merging stored and new data: status of rows, counters, newly found values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.schema import ATTR_KEY, ENTITY, ROW_KEY

NEW = "NEW"
UPDATE = "UPDATE"
UNCHANGED = "UNCHANGED"


def union_inputs(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both inputs as one bag, each row tagged with the side it came from."""
    return stored.withColumn("src", F.lit("store")).unionByName(
        new.withColumn("src", F.lit("new"))
    )


def classify(
    stored: DataFrame, new: DataFrame, key: list[str] = ROW_KEY, sizes: bool = False
) -> DataFrame:
    """Status of every key: NEW, UPDATE (stored and seen again) or UNCHANGED.

    One aggregation over both sides; each map task sends one row per key. ``sizes`` adds ``rows``,
    how many rows of both sides the key has.
    """
    counted = [F.count(F.lit(1)).alias("rows")] if sizes else []
    return (
        union_inputs(stored.select(*key), new.select(*key))
        .groupBy(*key)
        .agg(
            F.max(F.col("src") == "store").alias("in_store"),
            F.max(F.col("src") == "new").alias("in_new"),
            *counted,
        )
        .select(
            *key,
            F.when(~F.col("in_new"), F.lit(UNCHANGED))
            .when(F.col("in_store"), F.lit(UPDATE))
            .otherwise(F.lit(NEW))
            .alias("status"),
            *(["rows"] if sizes else []),
        )
    )


def keep_keys(
    rows: DataFrame,
    keys: DataFrame,
    key: list[str],
    how: str = "left_semi",
    next_key: list[str] | None = None,
) -> DataFrame:
    """Rows whose key is listed (``left_semi``) or not listed (``left_anti``).

    ``next_key`` is what the caller groups by afterwards. Shuffling on it here keeps the
    grouping from reusing the join's partitions, where a busy key is one task, and lets
    adaptive execution split that key in the join.
    """
    kept = rows.join(keys.select(*key).distinct(), key, how)
    return kept.repartition(*next_key) if next_key else kept


def changed_part(
    rows: DataFrame,
    new: DataFrame,
    key: list[str] = ROW_KEY,
    next_key: list[str] | None = None,
) -> DataFrame:
    """Rows whose key the new data touched."""
    return keep_keys(rows, new, key, "left_semi", next_key)


def unchanged_part(
    rows: DataFrame,
    new: DataFrame,
    key: list[str] = ROW_KEY,
    next_key: list[str] | None = None,
) -> DataFrame:
    """The other rows; with ``changed_part`` they are the whole."""
    return keep_keys(rows, new, key, "left_anti", next_key)


def new_values(stored: DataFrame, new: DataFrame, key: list[str] = ATTR_KEY) -> DataFrame:
    """Keys (by default row key, code and value) that the store has not seen yet.

    Both sides are reduced to distinct keys first, and the join key includes the value,
    so one busy entity spreads over all tasks.
    """
    known = stored.select(*key).distinct()
    return new.select(*key).distinct().join(known, key, "left_anti")


def stored_lookup(new_obs: DataFrame, stored_base: DataFrame) -> DataFrame:
    """For every row key of the new observations what the store holds under it."""
    arriving = new_obs.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("new_cnt"))
    held = stored_base.groupBy(*ROW_KEY).agg(
        F.count(F.lit(1)).alias("stored_values"),
        F.min("first_time").alias("stored_first_time"),
        F.max("last_time").alias("stored_last_time"),
    )
    return arriving.join(held, ROW_KEY, "left")


def row_bytes(rows: DataFrame) -> Column:
    """Size of a row: its texts in bytes and eight bytes per number."""
    size = F.lit(0)
    for name, kind in rows.dtypes:
        size = size + (F.octet_length(name) if kind == "string" else F.lit(8))
    return size


def merge_counters(stored: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """Rows and bytes read, written and left alone by a merge, for base and info.

    Both sides are day tables. Bytes are those of their rows: a merge reads what the
    store holds of a changed key, writes the new rows and leaves the other keys alone.
    One aggregation per key and one over the keys.
    """
    result = None
    for label, table, key in (("BASE", "attr_day", ROW_KEY), ("INFO", "entity_day", ENTITY)):
        both = union_inputs(
            *[side[table].withColumn("bytes", row_bytes(side[table])) for side in (stored, new)]
        )
        from_store = F.col("src") == "store"
        keys = both.groupBy(*key).agg(
            F.max(from_store).alias("in_store"),
            F.max(~from_store).alias("in_new"),
            F.sum(F.when(from_store, F.col("bytes")).otherwise(0)).alias("old_bytes"),
            F.sum(F.when(from_store, 0).otherwise(F.col("bytes"))).alias("new_bytes"),
        )
        is_new = F.col("in_new") & ~F.col("in_store")
        is_update = F.col("in_new") & F.col("in_store")
        counters = {
            "NUM_NEW": F.count_if(is_new),
            "NUM_UPDATE": F.count_if(is_update),
            "NUM_UNCHANGED": F.count_if(~F.col("in_new")),
            "BYTES_READ": F.sum(F.when(is_update, F.col("old_bytes")).otherwise(0)),
            "BYTES_WRITE": F.sum("new_bytes"),
            "BYTES_UNCHANGED": F.sum(F.when(F.col("in_new"), 0).otherwise(F.col("old_bytes"))),
        }
        total = keys.agg(
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"{label}_{n}") for n, c in counters.items()]
        )
        part = total.unpivot([], total.columns, "counter", "total")
        result = part if result is None else result.unionByName(part)
    return result
