"""Lookups of a stream in the store, and streams that fail between two steps of a batch."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from dossierlake.operators.merge import stored_lookup
from dossierlake.plans import profiles as plan
from dossierlake.plans.store import SnapshotStore
from dossierlake.sources import streams
from dossierlake.streaming import lookup
from dossierlake.streaming import merge as stream_merge
from tests.test_fold import DICTIONARY, WIDE, brute_force, collected, observations
from tests.test_streaming import add, wait


def found(spark, out):
    rows = spark.read.parquet(out("found"))
    return rows.groupBy("batch_id").agg(
        F.min("version").alias("v"), F.max("version").alias("w"), F.sum("new_cnt").alias("n"),
        F.count("stored_values").alias("held"),
    ).orderBy("batch_id").collect()


def test_a_version_committed_between_batches_is_seen(spark, out):
    rows = observations(21)
    store = SnapshotStore(spark, out("store"), buckets=4)
    for part in range(2):
        add(spark, out("in"), rows)
        source = streams.file_stream(spark, out("in"), WIDE)
        wait(lookup.start_stored_lookup(source, store, out("found"), out("cp"), "l"))
        plan.ingest(store, spark.createDataFrame(rows, WIDE), DICTIONARY, f"other {part}")
    first, second = found(spark, out)
    assert (first["v"], first["w"], first["held"], first["n"]) == (0, 0, 0, len(rows))
    assert (second["v"], second["w"], second["n"]) == (1, 1, len(rows)) and second["held"] > 0
    batch = spark.createDataFrame(rows, WIDE)
    got = lookup.look_up(batch, store).drop("version")
    held = plan.stored_profiles(store, DICTIONARY, 1).base
    want = stored_lookup(batch, held)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_replayed_batch_keeps_its_lookup(spark, out):
    rows = observations(22)
    store = SnapshotStore(spark, out("store"), buckets=4)
    add(spark, out("in"), rows)
    for checkpoint in ("a", "b"):
        source = streams.file_stream(spark, out("in"), WIDE)
        wait(lookup.start_stored_lookup(source, store, out("found"), out(checkpoint), "l", DICTIONARY))
    (only,) = found(spark, out)
    assert (only["v"], only["held"], only["n"]) == (0, 0, len(rows))
    assert collected(plan.stored_profiles(store, DICTIONARY)) == brute_force(rows)


class Stopped(SnapshotStore):
    """Fails ``times`` times before or after a version becomes visible."""

    def __init__(self, *args, after, times=1, **kwargs):
        super().__init__(*args, **kwargs)
        self.after, self.times = after, times

    def _commit(self, *args):
        if self.times and not self.after:
            self.times -= 1
            raise RuntimeError("before")
        version = super()._commit(*args)
        if self.times:
            self.times -= 1
            raise RuntimeError("after")
        return version


@pytest.mark.parametrize("after", [False, True])
def test_a_failure_in_a_gap_counts_nothing_twice(spark, out, after):
    rows = observations(23)
    add(spark, out("in"), rows, files=2)
    store = Stopped(spark, out("store"), 4, after=after)

    def start():
        source = streams.file_stream(spark, out("in"), WIDE, max_files_per_trigger=1)
        return stream_merge.start_profile_merge(source, store, DICTIONARY, out("cp"), "s")

    assert stream_merge.run_to_end(start) == 1
    assert collected(plan.stored_profiles(store, DICTIONARY)) == brute_force(rows)
    assert [r["batch_id"] for r in store.history().orderBy("version").collect()] == ["s:0", "s:1"]


def test_failures_after_the_last_restart_are_raised(spark, out):
    add(spark, out("in"), observations(24))
    store = Stopped(spark, out("store"), 4, after=False, times=3)

    def start():
        source = streams.file_stream(spark, out("in"), WIDE)
        return stream_merge.start_profile_merge(source, store, DICTIONARY, out("cp"), "s")

    with pytest.raises(StreamingQueryException, match="before"):
        stream_merge.run_to_end(start, restarts=1)
