"""Observations dealt out by entity: nothing that follows moves, and a busy entity is spread."""

import pytest
from pyspark.sql import functions as F

from dossierlake.operators import assemble, attributes, fold, placing
from dossierlake.plans import profiles as plan
from dossierlake.plans.profiles import attribute_rows
from dossierlake.plans.queries import common, profiles
from dossierlake.plans.store import SnapshotStore
from dossierlake.schema import ENTITY, ROW_KEY
from dossierlake.sources import adapters
from tests.test_fold import DICTIONARY, WIDE, observations

NULLS = [(None, None, None, None, None, t, 900 + t, "s1", "k,,l") for t in (5, 1_400_000_000)]
NULLS += [("t", "o1", "a", "p", "x", 1_400_000_000, 990, None, None), ("t", "o1", "a", "p", "x", 1_400_000_001, 990, "s1", "k")] * 2


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(observations(5) + NULLS, WIDE)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def rows_of(frame):
    return sorted(map(repr, frame.select(sorted(frame.columns)).collect()))


@pytest.mark.parametrize("most", [10, 10**6])
def test_queries_move_observations_once(spark, wide, monkeypatch, most):
    monkeypatch.setattr(profiles, "load_lines", lambda *_: wide)
    monkeypatch.setattr(profiles, "placing", lambda obs: placing.placing(obs, full=most, most=most))
    base = fold.base_profile(fold.fold_attr_day(attribute_rows(wide, profiles.DICTIONARY)))
    found = profiles.base_fold_lines(spark, "")
    assert rows_of(found) == rows_of(profiles.flat(base))
    for pages, length in ((None, 4), (3, 1000)):
        nested = profiles.nested(spark, "", pages, length)
        plain = assemble.nest_base(base, pages, length).select(*ROW_KEY, F.col("page").cast("bigint").alias("page"), F.size("props").cast("bigint").alias("n"))
        assert rows_of(nested.drop("props")) == rows_of(plain)
        assert most == 10 or exchanges(nested) == 1
    assert most == 10 or exchanges(found) == 1


def test_a_calm_entity_lies_in_one_task_and_a_busy_one_in_many(spark, wide, monkeypatch):
    monkeypatch.setattr(placing, "SLOT_OBSERVATIONS", 4)
    task = F.spark_partition_id().alias("task")
    some = wide.where("oid <> 'o2'")
    found = placing.placing(some, buckets=4, full=1, most=10**6)
    assert found.busy is None and found.busy_ones() is None and found.slots % 4 == 0
    for rows in (found.calm(), found.all(), found.entity_times()):
        per = rows.select(*ENTITY, task).distinct().groupBy(*ENTITY).count()
        assert per.where("count > 1").isEmpty() and rows.count() == some.count()
    found = placing.placing(wide, buckets=4, full=10, most=10)
    assert found.calm().where("oid = 'o2'").isEmpty() and not found.busy_ones().where("oid = 'o2'").isEmpty()
    assert found.calm().count() + found.busy_ones().count() == wide.count()
    each = found.slots // 4
    for rows, key in ((found.all(), ROW_KEY), (found.entity_times(), ENTITY)):
        lie = rows.select(*key, attributes.DAY, attributes.SLOT, task).distinct()
        assert lie.where(F.col("task") != F.col(attributes.SLOT)).isEmpty()
        assert lie.groupBy(*key, attributes.DAY).count().where("count > 1").isEmpty()
        busy = lie.where("oid = 'o2'").select(attributes.SLOT).distinct()
        assert busy.count() > 1
        # All of them belong to the entity's bucket.
        assert lie.select(*ENTITY, F.floor(F.col(attributes.SLOT) / each)).distinct().groupBy(*ENTITY).count().where("count > 1").isEmpty()


def test_slots_follow_the_rows(spark, monkeypatch):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert placing.slots_for(spark, 0) == 1 and placing.slots_for(spark, 10, 8) == 8
    assert placing.slots_for(spark, 60_000) == min(session, 3)
    assert placing.slots_for(spark, 216_000_000, 8) == 2160


def test_batches_are_written_where_they_are_folded(spark, wide, out, monkeypatch):
    monkeypatch.setattr(placing, "SLOT_OBSERVATIONS", 10)
    store = SnapshotStore(spark, out("store"), buckets=4)
    for most in (10, 10**6):
        found = placing.placing(wide, 4, full=most, most=most)
        tables = plan.placed_tables(found, DICTIONARY)
        assert most == 10 or [exchanges(t) for t in tables.values()] == [1, 1]
        store.append(tables, str(most))
        for name, plain in plan.day_tables(wide, DICTIONARY).items():
            newest = store.newest(name)
            assert attributes.SLOT not in newest.columns and rows_of(newest.drop("bucket")) == rows_of(plain)
            # No task has rows of two buckets, so there is a file for each slot at most.
            assert newest.select(F.input_file_name()).distinct().count() <= found.slots
    assert plan.ingest(store, wide, DICTIONARY, "10") == 2
    plan.ingest(store, wide, DICTIONARY, "third")
    assert rows_of(store.newest("attr_day").drop("bucket")) == rows_of(plan.day_tables(wide, DICTIONARY)["attr_day"])


def test_an_entity_of_the_sides_lies_in_one_file(spark, wide, monkeypatch):
    monkeypatch.setattr(placing, "SLOT_OBSERVATIONS", 10)
    monkeypatch.setitem(common.LOADERS, "o", lambda *_: wide)
    monkeypatch.setitem(common.SPLITS, "o", 1_400_086_400)
    halves = adapters.split_stored(wide, 1_400_086_400)
    for side, both, half in zip(common.attr_sides(spark, "", "o"), common.sides(spark, "", "o"), halves, strict=True):
        plain = plan.day_tables(half, common.DICTIONARY)
        assert rows_of(side) == rows_of(plain["attr_day"])
        assert {name: rows_of(rows) for name, rows in both.items()} == {name: rows_of(rows) for name, rows in plain.items()}
        files = side.select(*ENTITY, F.input_file_name().alias("file")).distinct()
        assert files.groupBy(*ENTITY).count().where("count > 1").isEmpty()
