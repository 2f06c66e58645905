"""Wide observations taken from the events table and from order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary
from dossierlake.functions.times import epoch_seconds
from dossierlake.session import pin_utc

# Codes of both adapters.
DICTIONARY = AttrDictionary(single=["S1", "S2"], multi=["M1"])

# Observations before this time count as stored, the others as new.
EVENTS_SPLIT = 1705708800  # 2024-01-20 00:00:00
LINES_SPLIT = 946684800  # 2000-01-01 00:00:00


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def event_observations(events: DataFrame) -> DataFrame:
    """A user is seen at every event; works on a batch and on a stream."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    d = F.concat(F.lit("d"), _text(k % 4))
    level = (
        F.when(F.col("value") < 50, "low").when(F.col("value") < 150, "mid").otherwise("high")
    )
    return events.select(
        F.lit("user").alias("entity_type"),
        _text(F.col("user_id")).alias("oid"),
        F.col("event_type").alias("data_source"),
        level.alias("protocol"),
        F.when(F.hour(F.col("ts").cast("timestamp")) < 12, "am").otherwise("pm").alias("action"),
        epoch_seconds(F.col("ts")).alias("capture_time"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("k"), _text(F.floor(k / 10))).alias("S1"),
        level.alias("S2"),
        F.concat_ws(",", d, F.concat(F.lit("e"), _text(k % 3)), d).alias("M1"),
    )


def line_observations(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """A customer is seen at every order line.

    The arrival number comes from order and line number alone. Lines that share it are
    told apart by the later keys of the fold's ordering, so no ranking is needed here.
    """
    lines = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.lit("customer").alias("entity_type"),
        _text(F.col("o_custkey")).alias("oid"),
        F.col("l_returnflag").alias("data_source"),
        F.col("l_linestatus").alias("protocol"),
        F.col("o_orderstatus").alias("action"),
        epoch_seconds(F.col("l_shipdate")).alias("capture_time"),
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("seq"),
        F.col("o_orderpriority").alias("S1"),
        F.concat("l_returnflag", "l_linestatus").alias("S2"),
        F.concat_ws(
            ",",
            F.concat(F.lit("s"), _text(F.col("l_suppkey") % 5)),
            F.concat(F.lit("q"), _text(F.floor(F.col("l_quantity") / 10))),
        ).alias("M1"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    return event_observations(events)


def load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    return line_observations(lineitem, orders)


def split_stored(obs: DataFrame, boundary: int) -> tuple[DataFrame, DataFrame]:
    """Older observations and the rest."""
    older = F.col("capture_time") < boundary
    return obs.where(older), obs.where(~older)
