"""Streaming sources of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossierlake.functions.keys import entity_key
from dossierlake.schema import OBS
from dossierlake.sources.generator import GeneratorConfig, generate

def kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    from_beginning: bool = False,
    starting_timestamp: int | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Topic as a stream. Needs the Kafka connector package on the cluster.

    Offsets live in the query's checkpoint. ``starting_timestamp`` (milliseconds) and
    ``from_beginning`` only matter for a query without a checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if from_beginning else "latest")
    )
    if starting_timestamp is not None:
        reader = reader.option("startingTimestamp", str(starting_timestamp))
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
    if min_partitions is not None:
        reader = reader.option("minPartitions", str(min_partitions))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def decode_messages(messages: DataFrame) -> DataFrame:
    """Observations from messages whose ``value`` bytes hold one JSON observation.

    The arrival number is the message's offset, if it has one, otherwise that of the message
    itself. Offsets order the messages of a partition, and the entity's digest is the key of
    a message, so all observations of an entity are in one partition. Undecodable messages are dropped here; see
    ``undecodable`` for them.
    """
    parsed = messages.select("*", F.from_json(F.col("value").cast("string"), OBS).alias("obs"))
    rows = parsed.where(F.col("obs.oid").isNotNull() & F.col("obs.capture_time").isNotNull())
    fields = [F.col(f"obs.{name}").alias(name) for name in OBS.names if name != "seq"]
    return rows.select(*fields, _arrival(messages).alias("seq")).select(*OBS.names)


def undecodable(messages: DataFrame) -> DataFrame:
    obs = F.from_json(F.col("value").cast("string"), OBS)
    bad = obs.isNull() | obs["oid"].isNull() | obs["capture_time"].isNull()
    return messages.where(bad)


def _arrival(messages: DataFrame):
    return F.col("offset") if "offset" in messages.columns else F.col("obs.seq")


def encode_messages(obs: DataFrame) -> DataFrame:
    """``key`` (entity digest) and ``value`` (JSON bytes) of observations."""
    return obs.select(
        entity_key(F.col("entity_type"), F.col("oid")).alias("key"),
        F.to_json(F.struct(*OBS.names)).cast("binary").alias("value"),
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream; ``archive_dir`` receives the files once read."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.format(fmt).load(path)


def generated_stream(
    spark: SparkSession, config: GeneratorConfig, tps: int, gap_millis: int = 1000
) -> DataFrame:
    """Synthetic observations at ``tps`` records per ``gap_millis`` milliseconds.

    Run it with ``throttle_trigger(gap_millis)``. For ids of another stream call
    ``generate`` on it: then that source's bound per trigger sets the pace.
    """
    ids = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", max(1, round(tps * 1000 / gap_millis)))
        .load()
    )
    return generate(ids, config, "value")


def throttle_trigger(gap_millis: int) -> dict[str, str]:
    """Trigger of a query that takes one bounded batch every ``gap_millis``.

    The bound itself is the source's (``max_per_trigger``, ``max_files_per_trigger``).
    """
    return {"processingTime": f"{gap_millis} milliseconds"}
