"""Rows dealt out once by row key against the same operators without it."""

from pyspark.sql import functions as F

from dossierlake.operators import documents, fold, parts
from dossierlake.plans.queries import profiles
from dossierlake.schema import ROW_KEY
from dossierlake.session import materialize


def day_rows(spark, rows):
    """Day rows of (oid, action, value, time)."""
    made = [("t", o, "d", "p", a, "M1", v, t, 1, t, t, t, t) for o, a, v, t in rows]
    types = ["string"] * 7 + ["int"] + ["bigint"] * 3 + ["decimal(38,0)"] * 2
    schema = ", ".join(f"{n} {t}" for n, t in zip(fold.ATTR_DAY, types, strict=True))
    frame = spark.createDataFrame([(*r[:11], None, None) for r in made], schema)
    return materialize(frame.repartition(3), "rows")


def two_sides(spark):
    old = [(o, a, f"v{i}", i) for o in ("1", "2", None) for a in "xy" for i in range(4)]
    old += [("busy", "x", f"b{i}", i % 5) for i in range(40)]
    new = [("1", "x", "v1", 9), ("1", "y", "other", 8), ("3", "x", "first", 7), (None, "x", "v1", 9)]
    new += [("busy", "x", f"b{i}", 9) for i in range(41)] + [("busy", "y", "b", 9)]
    return day_rows(spark, old), day_rows(spark, new)


def sorted_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_documents_are_those_of_rows_that_move_freely(spark):
    old, new = two_sides(spark)
    both = old.unionByName(new)
    for most in (20, 1000):
        by = parts.dealing(both, ROW_KEY, most)
        assert (by.busy is None) == (most == 1000)
        found = documents.base_rows_to_index(old, new, by)
        plain = documents.base_rows_to_index(old, new)
        assert sorted_rows(found) == sorted_rows(plain)
        for compat in (False, True):
            for pages, length in ((None, 7), (3, 7)):
                args = {"compat_ids": compat, "pages": pages, "length": length}
                for rows in (plain, None):
                    dealt = documents.base_documents(both, F.lit(0), rows, by=by, **args)
                    assert sorted_rows(dealt) == sorted_rows(documents.base_documents(both, F.lit(0), rows, **args))


def test_a_busy_key_lies_in_many_tasks_and_others_in_one(spark):
    old, new = two_sides(spark)
    by = parts.dealing(old.unionByName(new), ROW_KEY, 20)
    calm, busy = by.split(old.unionByName(new))
    assert busy.select("oid", "action").distinct().collect() == [("busy", "x")]
    tasks = calm.select("*", F.spark_partition_id().alias("task")).groupBy(*ROW_KEY).agg(F.count_distinct("task").alias("n"))
    assert tasks.where("n > 1").isEmpty()


def test_tasks_follow_the_rows(spark, monkeypatch):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts.tasks_for(spark, 10) == session
    assert parts.tasks_for(spark, 1000 * session, 100) == 10 * session
    monkeypatch.setattr(parts, "tasks_for", lambda _, rows: rows)
    old, new = two_sides(spark)
    both = old.unionByName(new)
    calm, _ = parts.dealing(both, ROW_KEY).split(both)
    assert calm.rdd.getNumPartitions() == both.count()


def test_split_parts_are_the_whole(spark, monkeypatch):
    monkeypatch.setattr(profiles, "attr_sides", lambda *_: two_sides(spark))
    for most in (20, 1000):
        monkeypatch.setattr(profiles, "dealing", lambda rows, key, most=most: parts.dealing(rows, key, most))
        # A key with a null is not found among the new ones.
        assert sorted_rows(profiles.changed_split(spark, "")) == [("d", 16, 17, "unchanged"), ("d", 52, 93, "changed")]
