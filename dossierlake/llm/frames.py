"""Helpers that the operators share: sessions, tables, Arrow columns, files of the shared folder."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What one Arrow batch of a Python stage holds at most; a longer row is a batch of its own.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Bounded Arrow batches, and workers that find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that no column of the table has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# Keys with this share of all rows are busy; there are at most as many as its inverse.
BUSY = 256


def join_busy(rows: DataFrame, table: DataFrame, key: str | list[str], weight: str = "pages") -> DataFrame:
    """Adds a table's columns, but for the weight, by a key that each row has there.

    ``table`` has one row per key; ``weight`` says how much the key holds. Keys with at least one
    ``BUSY``-th of all, at most ``BUSY`` rows, are broadcast, so their rows stay where they are.
    """
    keys = [key] if isinstance(key, str) else key
    busy = F.col(weight) >= table.agg((F.sum(weight) / BUSY).alias("share")).scalar()
    large = table.where(busy).drop(weight)
    small = table.where(~busy).drop(weight)
    kept = rows.join(F.broadcast(large), keys)
    others = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(small.hint("merge"), keys)
    return kept.unionByName(others)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column in one array, and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(ends) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, room: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes; a longer row is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + room, "right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end
        row = end


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file; a plain path is local."""
    return pafs.FileSystem.from_uri(path)
