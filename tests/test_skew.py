"""Busy keys come out whole, in the stated number of pages."""

import json

from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary
from dossierlake.operators import documents
from dossierlake.operators.accumulate import accumulate
from dossierlake.operators.numbering import in_ranges
from dossierlake.operators.parts import gather
from dossierlake.plans.profiles import load
from dossierlake.plans.store import SnapshotStore
from dossierlake.schema import ROW_KEY


def test_oversized_key_is_split_and_complete(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    whole = gather(rows, ["k"], F.col("v"), "items", ["v"], pages=1)
    assert {(r["page"], r["n"]) for r in whole.select("page", F.size("items").alias("n")).collect()} == {
        (0, 2500), (0, 10)
    }
    out = gather(rows, ["k"], F.col("v"), "items", ["v"], pages=25)
    sizes = out.select("k", "page", F.size("items").alias("n")).collect()
    hot = {r["page"]: r["n"] for r in sizes if r["k"] == "hot"}
    assert sum(hot.values()) == 2500 and sorted(hot) == list(range(25)) and max(hot.values()) < 200
    back = out.select("k", F.explode("items").alias("v"))
    assert back.exceptAll(rows).isEmpty() and back.count() == 3000


def hot_rows(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") * 3 < n, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.format_string("%07d", "id").alias("v"),
    )


def test_ranked_pages_are_full_and_in_order(spark):
    rows = hot_rows(spark, 6000)
    out = gather(rows, ["k"], F.col("v"), "items", ["v"], length=300).collect()
    hot = [r["items"] for r in sorted(out, key=lambda r: r.page) if r["k"] == "hot"]
    assert [len(items) for items in hot] == [300] * 6 + [200]
    assert [v for items in hot for v in items] == [f"{i:07d}" for i in range(2000)]
    assert sum(len(r["items"]) for r in out) == 6000


def test_a_busy_key_is_never_in_one_task(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = gather(hot_rows(spark, 6000), ["k"], F.col("v"), "items", ["v"], length=100)
        parts = frame.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    placed = in_ranges(hot_rows(spark, 6000), ["k", "v"])
    assert placed.where("k = 'hot'").select("slot").distinct().count() > 1


def test_documents_of_a_busy_entity_come_in_pages(spark):
    attr_day = spark.range(2500).select(
        *[F.lit("x").alias(c) for c in ROW_KEY], F.lit("M1").alias("code"), F.format_string("%05d", "id").alias("value"),
    )
    docs = documents.base_documents(attr_day, F.lit(0), length=1000).orderBy("page").collect()
    assert [(r.page, len(r.props)) for r in docs] == [(0, 1000), (1, 1000), (2, 500)]
    first = documents.base_documents(attr_day.limit(1), F.lit(0)).first().id
    assert [r.id for r in docs] == [first, f"{first}-1", f"{first}-2"]


def test_load_pages_the_documents_of_a_busy_entity(spark, out):
    obs = spark.range(900).select(
        *[F.lit("x").alias(c) for c in ROW_KEY], F.lit(0).cast("long").alias("capture_time"), F.col("id").alias("seq"),
        F.array(F.struct(F.lit("M1").alias("code"), F.format_string("%05d", "id").alias("value"))).alias("props"),
    )
    store = SnapshotStore(spark, out("store"), 4)
    load(store, obs, AttrDictionary(single=[], multi=["M1"]), "b", 0, out("docs"), page_items=400)
    base = [json.loads(r.value) for r in spark.read.text(f"{out('docs')}/base").collect()]
    info = [json.loads(r.value) for r in spark.read.text(f"{out('docs')}/info").collect()]
    assert sorted((d["page"], len(d["props"])) for d in base) == [(0, 400), (1, 400), (2, 100)]
    assert sorted((d["page"], len(d["M1"])) for d in info) == [(0, 400), (1, 400), (2, 100)]


def test_repeats_of_one_text_are_split(spark):
    fields = spark.range(1000).select(F.lit("s:a").alias("field"), F.lit("x").alias("value"))
    texts = accumulate(fields, length=300).orderBy("page").collect()
    assert [(r.page, r.value) for r in texts] == [(i, "x;" * n) for i, n in enumerate([300, 300, 300, 100])]


def test_accumulators_with_one_hot_text(spark):
    pairs = [("s:a", "x")] * 40 + [("s:a", "y")] * 3 + [("l:n", "4"), ("l:n", "5"), ("f:r", "0.5"), ("q:z", "1")]
    fields = spark.createDataFrame(pairs, "field string, value string")
    whole = {r["field"]: r["value"] for r in accumulate(fields).collect()}
    assert whole == {"s:a": "x;" * 40 + "y;" * 3, "l:n": "9", "f:r": "0.5"}
    parts = [r["value"] for r in accumulate(fields, pages=4).where("field = 's:a'").collect()]
    assert sorted(parts) in (["x;" * 40, "y;" * 3], [whole["s:a"]])
