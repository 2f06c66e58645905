"""Run log: one row per job with its counters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = (
    "job_id string, job_name string, state string, start_time timestamp, "
    "end_time timestamp, seconds bigint, counters map<string, bigint>"
)


def run_logged(
    spark: SparkSession, log_path: str, name: str, job: Callable[[], dict[str, int] | None]
) -> str:
    """Run a job and append its line; a failing job is logged too and raised again."""
    job_id = uuid.uuid4().hex
    started = datetime.now(timezone.utc)
    state, counters = "FAILED", None
    try:
        counters = job() or {}
        state = "SUCCEEDED"
    finally:
        ended = datetime.now(timezone.utc)
        row = (
            job_id, name, state, started, ended,
            int((ended - started).total_seconds()), counters or {},
        )
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    return job_id


def write_counted(rows: DataFrame, path: str, counters: dict[str, Column]) -> dict[str, int]:
    """Write rows and return the counters observed during that same pass."""
    seen = Observation()
    exprs = [c.alias(name) for name, c in counters.items()]
    rows.observe(seen, *exprs).write.mode("errorifexists").parquet(path)
    return {name: int(value or 0) for name, value in seen.get.items()}


def counter_lines(log: DataFrame) -> DataFrame:
    """Counters of every job, sorted by group (the part before the first ``.``) and name (the rest)."""
    lines = log.select("job_id", "job_name", F.explode("counters").alias("counter", "total"))
    return lines.select(
        "job_id",
        "job_name",
        F.substring_index("counter", ".", 1).alias("counter_group"),
        F.regexp_replace("counter", r"^[^.]*\.", "").alias("counter_name"),
        "total",
    ).orderBy("job_id", "counter_group", "counter_name")


def sorted_counters(log: DataFrame) -> DataFrame:
    """Counter lines with their place in the job's sorted list."""
    order = Window.partitionBy("job_id").orderBy("counter_group", "counter_name")
    return counter_lines(log).withColumn("place", F.row_number().over(order))


def log_text(log: DataFrame) -> DataFrame:
    """Tab separated lines: id, name, state, start, end, seconds, sorted counter values."""
    values = F.array_join(
        F.transform(F.array_sort(F.map_entries("counters")), lambda e: e["value"].cast("string")),
        "\t",
    )
    head = ["job_id", "job_name", "state", "start_time", "end_time", "seconds"]
    return log.select(
        F.concat_ws("\t", *[F.col(c).cast("string") for c in head], values).alias("value")
    )
