"""Known profiles of the hand-made observations, read from tagged files."""

import pytest
from pyspark.sql import functions as F

from dossierlake.functions.keys import entity_key
from dossierlake.operators import assemble, merge
from dossierlake.plans.profiles import (
    build_profiles,
    day_tables,
    ingest,
    merge_tables,
    profiles_of,
    stored_profiles,
)
from dossierlake.plans.store import SnapshotStore
from dossierlake.sources.tagged_tsv import scan_tagged
from tests import sample
from tests.sample import DICTIONARY


@pytest.fixture
def obs(spark, tmp_path):
    def read(name, rows):
        path = sample.write_file(tmp_path / name, rows)
        return scan_tagged(spark, path, DICTIONARY).observations

    return read("first.bcp", sample.FIRST), read("second.bcp", sample.SECOND)


def shown(base):
    cols = ["oid", "data_source", "code", "value", "cnt", "first_time", "last_time", "day_stats"]
    return {tuple(r) for r in assemble.show_base(base).select(cols).collect()}


def test_base_profile(obs):
    base = build_profiles(obs[0], DICTIONARY).base
    expected = (
        sample.group_rows("u1", "116", "Bob", "10")
        | sample.group_rows("u2", "116", "Bob", "11")
        | sample.group_rows("u1", "120", "Cyd", "12", ("a2", 1))
    )
    assert shown(base) == expected
    assert len(expected) == 19


def test_info_profile(obs):
    profiles = build_profiles(obs[0], DICTIONARY)
    info = {
        r["oid"]: (r["cnt"], r["first_time"], r["last_time"], r["day_cnt"])
        for r in assemble.show_info(profiles.info).collect()
    }
    assert info == {
        "u1": (10, "2014-10-01 12:05:20", "2014-12-11 12:05:23", 8),
        "u2": (5, "2014-11-01 12:05:20", "2014-11-11 12:05:23", 4),
    }
    attrs = {
        (r["oid"], r["code"], r["value"], r["last_time"])
        for r in assemble.show_info_attributes(profiles.info_attr).collect()
    }
    assert attrs == {
        ("u1", "B010001", "Cyd", "2014-12-11 12:05:23"),
        ("u1", "B010011", "1", "2014-12-11 12:05:23"),
        ("u1", "B010007", "a", "2014-12-02 12:05:22"),
        ("u1", "B010007", "b", "2014-12-11 12:05:23"),
        ("u1", "B010007", "c", "2014-12-11 12:05:23"),
        ("u1", "B010007", "a2", "2014-12-05 12:05:24"),
        ("u2", "B010001", "Bob", "2014-11-11 12:05:23"),
        ("u2", "B010011", "1", "2014-11-11 12:05:23"),
        ("u2", "B010007", "a", "2014-11-05 12:05:24"),
        ("u2", "B010007", "b", "2014-11-11 12:05:23"),
        ("u2", "B010007", "c", "2014-11-11 12:05:23"),
    }


def test_merge_status_and_counters(obs):
    old, new = (day_tables(o, DICTIONARY) for o in obs)
    status = merge.classify(old["attr_day"], new["attr_day"])
    assert {(r["oid"], r["data_source"], r["status"]) for r in status.collect()} == {
        ("u1", "116", "UPDATE"),
        ("u3", "116", "NEW"),
        ("u2", "116", "UNCHANGED"),
        ("u1", "120", "UNCHANGED"),
    }
    counters = {r["counter"]: r["total"] for r in merge.merge_counters(old, new).collect()}
    assert [counters[f"BASE_NUM_{s}"] for s in ("NEW", "UPDATE", "UNCHANGED")] == [1, 1, 2]
    assert [counters[f"INFO_NUM_{s}"] for s in ("NEW", "UPDATE", "UNCHANGED")] == [1, 1, 1]
    assert counters["BASE_BYTES_READ"] > 0 and counters["BASE_BYTES_UNCHANGED"] > 0


def test_merged_profile(obs):
    old, new = (day_tables(o, DICTIONARY) for o in obs)
    base = profiles_of(merge_tables(old, new), DICTIONARY).base
    rows = {
        (r["code"], r["value"]): (r["cnt"], r["day_cnt"], r["first_time"])
        for r in assemble.show_base(base).where("oid = 'u1' AND data_source = '116'").collect()
    }
    assert rows["B010001", "Bob"] == (4, 3, "2013-10-11 12:05:23")
    assert rows["B010007", "b"][:2] == (4, 3)
    assert rows["B010007", "c"][:2] == (2, 2)
    assert rows["B010011", "1"][:2] == (6, 5)
    assert rows["B010001", "Ada"][:2] == (2, 2)
    assert rows["B010007", "a"][:2] == (3, 3)


def test_late_multi_value_keeps_its_last_time(spark, obs, out):
    """Late data: last_time is a maximum, the arrival variant follows the arrival."""
    store = SnapshotStore(spark, out("golden"), buckets=2)
    for n, part in enumerate(obs):
        ingest(store, part, DICTIONARY, f"file{n}", by_batch=True)
    info = stored_profiles(store, DICTIONARY).info_attr.where("oid = 'u1'")
    found = {
        (r["code"], r["value"]): (r["last_time"], r["last_arrival_time"]) for r in info.collect()
    }
    assert found["B010007", "b"] == (1418299523, 1381493123)
    assert ("B010001", "Cyd") in found


def test_entity_key(spark):
    import hashlib

    row = spark.range(1).select(entity_key(F.lit("one.example"), F.lit("u1"))).first()
    assert row[0] == hashlib.md5(b"one.example\x01u1").hexdigest()
