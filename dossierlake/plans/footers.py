"""Counts of a store from the footers of its Parquet files, without reading its rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from dossierlake.plans.store import SnapshotStore
from dossierlake.session import materialize

ROWS = "*"
PARTS = ["segment", "bucket"]
V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footers_only(spark: SparkSession) -> Iterator[None]:
    """Parquet is read by the source that answers counts from footers; settings are put back."""
    before = {key: spark.conf.get(key) for key in (V1_SOURCES, PUSH_DOWN)}
    others = [name for name in before[V1_SOURCES].split(",") if name.strip() != "parquet"]
    spark.conf.set(V1_SOURCES, ",".join(others))
    spark.conf.set(PUSH_DOWN, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scan_counts(scan: DataFrame) -> DataFrame:
    """Rows and filled cells of each column per segment and bucket (plan it in ``footers_only``).

    Grouping by exactly the folder columns is what lets the source answer.
    """
    columns = [f for f in scan.schema.fields if f.name not in PARTS]
    nested = [f.name for f in columns if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    if nested:
        raise ValueError(f"footers do not count nested columns: {', '.join(nested)}")
    cells = [F.count(F.col(f.name)).alias(f.name) for f in columns]
    return scan.groupBy(*PARTS).agg(F.count(F.lit(1)).alias(ROWS), *cells)


def count_cells(
    store: SnapshotStore, tables: Sequence[str], version: int | None = None
) -> DataFrame:
    """Rows (column ``*``) and filled cells of every column per bucket, and over all buckets (null).

    Rows are those of the stored segments; compact the store first to count each key once. Tables
    that the version does not list have no rows here. Counting reads a footer per file; what is
    summed has a row per segment, bucket and column, and is written before the settings go back.
    """
    parts = []
    with footers_only(store.spark):
        for table in tables:
            for scan in store.scans(table, version):
                counted = scan_counts(scan)
                names = [c for c in counted.columns if c not in PARTS]
                long = counted.unpivot(["bucket"], [f"`{c}`" for c in names], "column", "n")
                parts.append(long.select(F.lit(table).alias("table"), "column", "bucket", "n"))
        if not parts:
            empty = "table string, column string, bucket int, n bigint"
            return store.spark.createDataFrame([], empty)
        every = materialize(reduce(DataFrame.unionByName, parts), "footer-counts")
    sets = [["table", "column", "bucket"], ["table", "column"]]
    return every.groupingSets(sets, "table", "column", "bucket").agg(F.sum("n").alias("n"))
