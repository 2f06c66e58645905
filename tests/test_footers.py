"""Counts from footers, and row groups that a lookup does not read."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from dossierlake.operators.lookup import entity_filter
from dossierlake.plans import footers
from dossierlake.plans.store import SnapshotStore

CELLS = "entity_type string, oid string, a string, b bigint"


def counted(store, tables=("t",), version=None):
    return {(r["column"], r["bucket"]): r["n"] for r in footers.count_cells(store, tables, version).collect()}


def brute(rows):
    want = {}
    for row in rows:
        for name, value in [("*", 1), *row.asDict().items()]:
            if name != "bucket":
                for key in ((name, row["bucket"]), (name, None)):
                    want[key] = want.get(key, 0) + (value is not None)
    return want


def test_counts_equal_the_rows(spark, out):
    store = SnapshotStore(spark, out("s"), buckets=4)
    rows = [("t", str(i), "x" if i % 3 else None, i if i % 5 else None) for i in range(60)]
    store.append({"t": spark.createDataFrame(rows[:40], CELLS)}, "1")
    store.append({"t": spark.createDataFrame(rows[30:], CELLS)}, "2")
    assert counted(store) == brute(store.read("t").collect())
    bucket = store.read("t").first()["bucket"]
    kept = store.read("t").where(F.col("bucket") == bucket).where("b > 20").drop("bucket")
    store.rewrite({"t": kept}, "3", [bucket])
    assert counted(store) == brute(store.read("t").collect())
    assert counted(store, version=1) == brute(store.read("t", 1).collect())
    assert counted(store, ["none"]) == {}


def test_counts_are_pushed_into_the_scan(spark, out):
    store = SnapshotStore(spark, out("s"), buckets=4)
    store.append({"t": spark.createDataFrame([("t", "1", None, 1), ("t", "2", "x", 2)], CELLS)}, "1")
    store.rewrite({"t": spark.createDataFrame([], CELLS)}, "2", [store.read("t").first()["bucket"]])
    before = {k: spark.conf.get(k) for k in (footers.V1_SOURCES, footers.PUSH_DOWN)}
    with footers.footers_only(spark), contextlib.redirect_stdout(io.StringIO()) as plan:
        footers.scan_counts(store.scans("t")[0]).explain("formatted")
    assert "PushedAggregation: [COUNT(*), COUNT(entity_type)" in plan.getvalue()
    assert {k: spark.conf.get(k) for k in before} == before


def test_nested_columns_are_refused(spark, out):
    store = SnapshotStore(spark, out("s"), buckets=2)
    nested = spark.createDataFrame([("t", "1", ["x"])], "entity_type string, oid string, a array<string>")
    store.append({"t": nested}, "1")
    with pytest.raises(ValueError, match="nested columns: a"):
        footers.count_cells(store, ["t"])


def rows_scanned(frame):
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_lookup_of_an_absent_id_reads_no_row_group(spark, out):
    """More ids than a dictionary page holds, and an absent one between them."""
    store = SnapshotStore(spark, out("s"), buckets=1)
    ids = spark.range(60_000).select(F.lit("t").alias("entity_type"), F.md5(F.col("id").cast("string")).alias("oid"))
    store.append({"t": ids.coalesce(1)}, "1")
    plain = out("plain")
    store.read("t").coalesce(1).sortWithinPartitions("oid").write.parquet(plain)

    def look(table, oid):
        return table.where(entity_filter(table, "t", oid)).select("oid")

    absent = "7" * 32
    assert rows_scanned(look(store.read("t"), absent)) == 0
    assert rows_scanned(look(spark.read.parquet(plain), absent)) > 0
    present = ids.first()["oid"]
    assert look(store.read("t"), present).count() == 1
