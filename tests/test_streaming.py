"""Streams give what a batch gives, also after a restart and for late data."""

import time

import pytest
from pyspark.sql import functions as F

from dossierlake.operators.attributes import collect_props
from dossierlake.operators.fold import fold_attr_day
from dossierlake.plans import profiles as plan
from dossierlake.plans.store import SnapshotStore
from dossierlake.sources import generator, streams
from dossierlake.streaming import merge as stream_merge
from dossierlake.streaming import sinks
from tests.test_fold import DICTIONARY, WIDE, brute_force, collected, observations


def wait(query):
    query.awaitTermination(120)
    assert query.exception() is None


def add(spark, path, rows, files=1):
    spark.createDataFrame(rows, WIDE).repartition(files).write.mode("append").parquet(path)


def test_restarted_stream_equals_batch(spark, out):
    rows = observations(11)
    store = SnapshotStore(spark, out("store"), buckets=4)
    for part in (rows[60:], rows[:60]):  # late data in the second run
        add(spark, out("in"), part, files=2)
        source = streams.file_stream(spark, out("in"), WIDE, max_files_per_trigger=1)
        wait(stream_merge.start_profile_merge(
            source, store, DICTIONARY, out("cp"), "s", compact_every=3))
    got = collected(plan.stored_profiles(store, DICTIONARY))
    want = brute_force(rows)
    assert got == want
    assert store.segment_count("attr_day") < 3


def test_stateful_aggregation_equals_batch(spark, out):
    rows = observations(12)
    add(spark, out("in"), rows, files=3)
    source = streams.file_stream(spark, out("in"), WIDE, max_files_per_trigger=1)
    query = (
        stream_merge.running_attr_day(source, DICTIONARY).writeStream.outputMode("complete")
        .format("memory").queryName("running").option("checkpointLocation", out("cp"))
        .trigger(availableNow=True).start()
    )
    wait(query)
    batch = fold_attr_day(plan.attribute_rows(spark.createDataFrame(rows, WIDE), DICTIONARY))
    state = spark.table("running").select(*batch.columns)
    assert state.exceptAll(batch).isEmpty() and batch.exceptAll(state).isEmpty()


def test_change_feeds(spark, out):
    rows = observations(13)
    add(spark, out("in"), rows, files=3)
    source = streams.file_stream(spark, out("in"), WIDE, max_files_per_trigger=1)
    store = SnapshotStore(spark, out("store"), buckets=4)
    wait(stream_merge.start_change_feed(source, store, DICTIONARY, out("feed"), out("cp1"), "f"))
    wait(sinks.write_rolled_stream(
        stream_merge.first_seen(source, DICTIONARY), out("seen"), out("cp2")))
    want = sorted(brute_force(rows)[0])
    for frame in (spark.read.parquet(out("feed")).drop("batch_id"), spark.read.parquet(out("seen"))):
        assert sorted(tuple(r) for r in frame.collect()) == want


def test_messages_decode_and_bad_ones_are_kept_apart(spark):
    obs = collect_props(spark.createDataFrame(observations(14), WIDE), DICTIONARY)
    messages = streams.encode_messages(obs)
    assert streams.decode_messages(messages).exceptAll(obs.select("*")).count() == 0
    broken = messages.limit(1).withColumn("value", F.lit("nonsense").cast("binary"))
    both = messages.unionByName(broken)
    assert streams.decode_messages(both).count() == obs.count()
    assert streams.undecodable(both).count() == 1
    queued = messages.withColumns({"timestamp": F.timestamp_millis(F.lit(5)), "offset": F.lit(1_000_007)})
    assert {r["seq"] for r in streams.decode_messages(queued).select("seq").collect()} == {1_000_007}


def test_rotation_by_size_date_and_text(spark, out):
    rows = observations(15)
    add(spark, out("in"), rows)
    source = streams.file_stream(spark, out("in"), WIDE)
    rotation = sinks.Rotation.by_size(1, "KB", record_bytes=64)
    wait(sinks.write_rolled_stream(
        sinks.with_date(source, F.col("capture_time")), out("files"), out("cp1"), rotation,
        partition_by=["dt"], codec="gzip"))
    written = spark.read.parquet(out("files"))
    per_file = written.groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in per_file) <= 16 and written.count() == len(rows)
    assert set(written.select(F.col("dt").cast("string")).distinct().toPandas()["dt"]) <= {
        "20140513", "20140514",
    }
    wait(sinks.write_rolled_stream(
        source, out("text"), out("cp2"), fmt="text", fields=["seq", "action"], delimiter=";"))
    lines = {r["value"] for r in spark.read.text(out("text")).collect()}
    assert lines == {f"{r[6]};{r[4] or 'null'}" for r in rows}


def test_rotation_settings():
    assert sinks.Rotation.by_time(20, "minutes").trigger == {"processingTime": "1200000 milliseconds"}
    assert sinks.Rotation.by_size(5, "MB", 1024).max_records == 5120
    assert sinks.Rotation.never().max_records == 0
    for bad in (lambda: sinks.Rotation.by_time(1, "eons"), lambda: sinks.Rotation.by_size(1, "PB", 1)):
        with pytest.raises(ValueError):
            bad()


def test_replayed_batch_overwrites_its_folder(spark, out):
    add(spark, out("in"), observations(16))
    for attempt in ("a", "b"):
        source = streams.file_stream(spark, out("in"), WIDE)
        wait(sinks.write_batch_folders(source, out("batches"), out(f"cp-{attempt}")))
    assert spark.read.parquet(out("batches")).count() == 120


def test_finished_files_move_to_an_archive(spark, out, tmp_path):
    add(spark, out("in"), observations(17), files=1)
    for n in range(3):
        source = streams.file_stream(spark, out("in"), WIDE, archive_dir=out("archive"))
        wait(sinks.write_batch_folders(source, out("next"), out("cp")))
        if n < 2:
            add(spark, out("in"), observations(18 + n), files=1)
    assert spark.read.parquet(out("next")).count() == 360
    assert list((tmp_path / "archive").rglob("*.parquet"))


def test_print_stream(spark, out):
    obs = collect_props(spark.createDataFrame(observations(19, 5), WIDE), DICTIONARY)
    streams.encode_messages(obs).write.parquet(out("in"))
    source = streams.file_stream(spark, out("in"), "key string, value binary")
    wait(sinks.print_stream(streams.decode_messages(source), out("cp"), "memory", "printed"))
    rows = spark.table("printed").orderBy("seq").collect()
    assert [r["seq"] for r in rows] == [0, 1, 2, 3, 4] and rows[0]["props"].startswith("S1=")


def test_throttled_generator_stream(spark, out):
    config = generator.GeneratorConfig(day_start=0)
    source = streams.generated_stream(spark, config, tps=20, gap_millis=500)
    query = (
        source.writeStream.format("memory").queryName("generated")
        .option("checkpointLocation", out("cp")).trigger(**streams.throttle_trigger(500)).start()
    )
    deadline = time.time() + 60
    while spark.table("generated").count() < 40 and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    rows = spark.table("generated")
    assert rows.count() >= 40
    batch = generator.generate(spark.range(rows.count()), config)
    assert rows.exceptAll(batch).isEmpty()
