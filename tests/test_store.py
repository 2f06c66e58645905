"""Versioned store: versions, idempotent batches, deletes, pruning, documents, run log."""

import json

import pytest
from pyspark.sql import functions as F

from dossierlake.operators import lookup
from dossierlake.plans import profiles as plan
from dossierlake.plans import runlog
from dossierlake.plans.store import SnapshotStore, parquet_codec
from tests.test_fold import DICTIONARY, WIDE, brute_force, collected, observations


def entities(spark, *oids):
    return spark.createDataFrame([("t", o) for o in oids], "entity_type string, oid string")


@pytest.fixture
def filled(spark, out):
    store = SnapshotStore(spark, out("store"), buckets=4)
    rows = observations(5)
    for name, part in (("one", rows[:50]), ("two", rows[50:])):
        plan.ingest(store, spark.createDataFrame(part, WIDE), DICTIONARY, name)
    return store, rows


def test_versions_and_compaction(spark, filled):
    store, rows = filled
    assert collected(plan.stored_profiles(store, DICTIONARY)) == brute_force(rows)
    assert collected(plan.stored_profiles(store, DICTIONARY, 1))[:2] == brute_force(rows[:50])[:2]
    plan.compact(store, "fold")
    assert store.segment_count("attr_day") == 1
    assert collected(plan.stored_profiles(store, DICTIONARY)) == brute_force(rows)
    assert SnapshotStore(spark, store.root, buckets=99).buckets == 4
    assert store.history().count() == 3
    with pytest.raises(ValueError):
        store.read("attr_day", 42)


def test_batch_is_taken_once(spark, filled):
    store, rows = filled
    assert plan.ingest(store, spark.createDataFrame(rows, WIDE), DICTIONARY, "two") == 2
    assert collected(plan.stored_profiles(store, DICTIONARY))[1] == brute_force(rows)[1]


def test_delete(spark, filled):
    store, rows = filled
    plan.delete_entities(store, entities(spark, "o1", "nobody"), "del")
    left = [r for r in rows if r[1] != "o1"]
    assert collected(plan.stored_profiles(store, DICTIONARY)) == brute_force(left)
    plan.delete_entities(store, entities(spark, "o2"), "del base", info=False)
    profiles = plan.stored_profiles(store, DICTIONARY)
    assert profiles.base.where("oid = 'o2'").isEmpty()
    assert not profiles.info.where("oid = 'o2'").isEmpty()
    assert collected(plan.stored_profiles(store, DICTIONARY, 2)) == brute_force(rows)


def test_lookup_reads_one_bucket(spark, filled):
    store, rows = filled
    table = store.read("attr_day")
    match = lookup.entity_filter(table, "t", "o1", store.buckets)
    text = table.where(match)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text
    assert "EqualTo(oid,o1)" in text
    found = plan.find_in_store(store, match, DICTIONARY)
    want = brute_force([r for r in rows if r[1] == "o1"])
    assert collected(found) == want
    assert lookup.or_note(found.info.where("oid = 'x'")) == lookup.EMPTY_NOTE


def test_base_lookup_prefix(spark):
    base = spark.createDataFrame(
        [("t", "o", "11", "p", "x"), ("t", "o", "116", "p", "x"), ("t", "o2", "11", "p", "x")],
        "entity_type string, oid string, data_source string, protocol string, action string",
    )
    assert lookup.find_base(base, "t", "o", ["11"]).count() == 1
    assert lookup.find_base(base, "t", "o", ["11"], prefix_last=True).count() == 2
    assert lookup.find_base(base, "t", "o").count() == 2


def test_load_writes_documents_of_what_is_new(spark, out):
    store = SnapshotStore(spark, out("store"), buckets=4)
    row = ("t", "o", "d", "p", "x", 1_400_000_000, 0, "s", "k,m")
    again = ("t", "o", "d", "p", "x", 1_400_000_009, 1, "s2", "k")
    for n, r in enumerate((row, row, again)):
        obs = spark.createDataFrame([r], WIDE)
        plan.load(store, obs, DICTIONARY, f"b{n}", as_of=77, documents_path=out(f"docs{n}"))
    base = [json.loads(r["value"]) for r in spark.read.text(out("docs0/base")).collect()]
    assert base[0]["props"] == [{"M1": "k"}, {"M1": "m"}, {"S1": "s"}]
    assert base[0]["H010014"] == 77 and base[0]["H010001"] == "p" and base[0]["page"] == 0
    info = [json.loads(r["value"]) for r in spark.read.text(out("docs0/info")).collect()]
    assert info[0]["S1"] == "s" and info[0]["M1"] == ["k", "m"] and info[0]["A010002"] == "o"
    for kind in ("base", "info"):
        assert spark.read.text(out(f"docs1/{kind}")).isEmpty()
    info = [json.loads(r["value"]) for r in spark.read.text(out("docs2/info")).collect()]
    assert info[0]["S1"] == "s2"
    base = [json.loads(r["value"]) for r in spark.read.text(out("docs2/base")).collect()]
    assert {"S1": "s"} in base[0]["props"] and {"S1": "s2"} in base[0]["props"]


def test_serving_upsert(spark, out):
    rows = observations(9)
    old, new = (
        plan.day_tables(spark.createDataFrame(r, WIDE), DICTIONARY)["attr_day"]
        for r in (rows[:60], rows[60:])
    )
    serving = SnapshotStore(spark, out("serving"), buckets=4)
    plan.export_changed(serving, None, old, "a")
    plan.export_changed(serving, old, new, "b")
    got = {
        tuple(r[c] for c in plan.ROW_KEY + ["code", "value"]): r["cnt"]
        for r in serving.read("base").collect()
    }
    assert got == {k: v[0] for k, v in brute_force(rows)[0].items()}


def test_codec_choice():
    assert parquet_codec(None) == "snappy" and parquet_codec("GzipCodec") == "gzip"
    assert parquet_codec("strange") == "snappy"
    with pytest.raises(ValueError):
        parquet_codec("LzoCodec")


def test_run_log(spark, out):
    rows = spark.range(10)
    runlog.run_logged(
        spark, out("log"), "good",
        lambda: runlog.write_counted(rows, out("x"), {"b.rows": F.count(F.lit(1)), "a.sum": F.sum("id")}),
    )
    with pytest.raises(ZeroDivisionError):
        runlog.run_logged(spark, out("log"), "bad", lambda: 1 / 0)
    log = spark.read.parquet(out("log"))
    assert {(r["job_name"], r["state"]) for r in log.collect()} == {
        ("good", "SUCCEEDED"), ("bad", "FAILED"),
    }
    lines = [(r["counter_group"], r["counter_name"], r["total"]) for r in runlog.counter_lines(log).collect()]
    assert lines == [("a", "sum", 45), ("b", "rows", 10)]
    text = [r["value"] for r in runlog.log_text(log.where("job_name = 'good'")).collect()]
    assert text[0].endswith("\t45\t10")


def test_keys_of_a_delete_are_made_once(spark, filled):
    store, rows = filled
    made = spark.sparkContext.accumulator(0)

    def seen(oid):
        made.add(1)
        return oid

    keys = entities(spark, "o1", "o2", "o1").select("entity_type", F.udf(seen, "string")("oid").alias("oid"))
    plan.delete_entities(store, keys, "del")
    assert made.value == 3
    left = {r["oid"] for r in plan.stored_profiles(store, DICTIONARY).base.select("oid").collect()}
    assert left == {r[1] for r in rows} - {"o1", "o2"}
