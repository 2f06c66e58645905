"""Stream output: rolled files, per-batch folders, console."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossierlake.functions.keys import entity_key
from dossierlake.operators.assemble import delimited_line, show_observations
from dossierlake.plans.store import parquet_codec
from dossierlake.streaming.merge import start_each_batch

# Units of a file size and of a rotation interval.
SIZE_UNITS = {"KB": 2**10, "MB": 2**20, "GB": 2**30, "TB": 2**40}
TIME_UNITS = ("seconds", "minutes", "hours", "days")


@dataclass(frozen=True)
class Rotation:
    """When output files are closed.

    * ``by_time``: a batch, and so its files, every interval
    * ``by_size``: files are cut at a number of records worth the size
    * ``never``: one run over what is there, each task writes a single file
    """

    trigger: dict
    max_records: int = 0

    @classmethod
    def by_time(cls, amount: float, unit: str) -> Rotation:
        if unit not in TIME_UNITS:
            raise ValueError(f"unknown unit of time: {unit}")
        seconds = amount * {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}[unit]
        return cls({"processingTime": f"{int(seconds * 1000)} milliseconds"})

    @classmethod
    def by_size(cls, amount: float, unit: str, record_bytes: int) -> Rotation:
        if unit not in SIZE_UNITS:
            raise ValueError(f"unknown unit of size: {unit}")
        records = int(amount * SIZE_UNITS[unit]) // max(1, record_bytes)
        return cls({"availableNow": True}, max(1, records))

    @classmethod
    def never(cls) -> Rotation:
        return cls({"availableNow": True})


def keyed_messages(obs: DataFrame) -> DataFrame:
    """Key/value rows: entity digest and the observation as JSON."""
    return obs.select(
        entity_key(F.col("entity_type"), F.col("oid")).alias("key"),
        F.to_json(F.struct(*obs.columns)).alias("value"),
    )


def with_date(rows: DataFrame, seconds: Column | None = None) -> DataFrame:
    """Add the output date ``dt``: of processing, or of the given epoch seconds."""
    moment = F.current_timestamp() if seconds is None else F.timestamp_seconds(seconds)
    return rows.withColumn("dt", F.date_format(moment, "yyyyMMdd"))


def write_rolled_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    rotation: Rotation | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    codec: str = "snappy",
    fields: Sequence[str] | None = None,
    delimiter: str = ",",
) -> StreamingQuery:
    """Write a stream into files that appear only when they are complete.

    ``fmt="text"`` writes delimited lines of ``fields``; partition columns stay out of
    the line. The checkpoint makes a restarted query continue without gap or repeat.
    """
    rotation = rotation or Rotation.never()
    if fmt == "text":
        names = [c for c in (fields or rows.columns) if c not in partition_by]
        rows = rows.select(delimited_line(names, delimiter), *partition_by)
    writer = (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**rotation.trigger)
    )
    if fmt == "parquet":
        writer = writer.option("compression", parquet_codec(codec))
    if rotation.max_records:
        writer = writer.option("maxRecordsPerFile", rotation.max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def write_batch_folders(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Each micro-batch in a folder of its own; a replayed batch overwrites its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return start_each_batch(rows, write, checkpoint, trigger=trigger)


def print_stream(
    obs: DataFrame,
    checkpoint: str,
    sink: str = "console",
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Print decoded observations with their sequence number."""
    writer = show_observations(obs).writeStream.format(sink).option(
        "checkpointLocation", checkpoint
    )
    if sink == "console":
        writer = writer.option("truncate", "false")
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
