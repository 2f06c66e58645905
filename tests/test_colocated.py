"""Bucketed profiles: the stored side is merged where it lies."""

import re

import pytest
from pyspark.sql import functions as F

from dossierlake.operators import fold, merge
from dossierlake.plans.colocated import BUCKET_ROWS, BucketedProfiles, buckets_for, joins_within_buckets
from dossierlake.plans.profiles import attribute_rows
from dossierlake.schema import ROW_KEY
from dossierlake.session import work_dir
from dossierlake.sources import adapters

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def halves(spark):
    sides = adapters.split_stored(adapters.load_events(spark, SMALL), adapters.EVENTS_SPLIT)
    tables = []
    for side in sides:
        path = work_dir(spark, "side")
        fold.fold_attr_day(attribute_rows(side, adapters.DICTIONARY)).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def store_of(spark, day_table, pages=1):
    return BucketedProfiles(spark, work_dir(spark, "bucketed"), 5, pages).build(fold.base_profile(day_table))


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(
        *ROW_KEY, "code", "value", "cnt", "first_time", "last_time", "day_cnt", fold.days_text(F.col("days")), "status"
    ).collect())


@pytest.mark.parametrize("pages", [1, 3])
def test_merge_equals_folding_both_sides(spark, halves, pages):
    old, new = halves
    merged = store_of(spark, old, pages).merge(fold.base_profile(new), work_dir(spark, "bucketed"))
    whole = fold.base_profile(fold.merge_attr_day(old, new)).join(merge.classify(old, new), ROW_KEY)
    assert rows_of(merged.read("base")) == rows_of(whole)
    keys = old.select(*ROW_KEY).union(new.select(*ROW_KEY)).distinct().count()
    assert merged.read("keys").count() == keys * pages


def test_no_exchange_above_the_stored_scan(spark, halves):
    old, new = halves
    store = store_of(spark, old, 2)
    with joins_within_buckets(spark):
        for frame in (store.merged(fold.base_profile(new)), store.merged_keys(fold.base_profile(new))):
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0].splitlines()
            depth = lambda line: len(re.match(r"[ :|+\-*]*", line).group())
            scans = [i for i, line in enumerate(final) if "Bucketed: true" in line]
            assert scans
            for at in scans:
                above, level = [], depth(final[at])
                for line in reversed(final[:at]):
                    if depth(line) < level:
                        above.append(line)
                        level = depth(line)
                assert not any("Exchange" in line for line in above), "\n".join(final)


def test_a_later_session_declares_the_tables(spark, halves):
    store = store_of(spark, halves[0], 2)
    want = store.read("base").count()
    for table in ("base", "keys"):
        spark.sql(f"DROP TABLE {store._name(table)}")
    again = BucketedProfiles(spark, store.path, store.buckets, store.pages)
    assert again.read("base").count() == want
    merged = again.merge(fold.base_profile(halves[1]), work_dir(spark, "bucketed"))
    assert merged.merge(fold.base_profile(halves[1]), work_dir(spark, "bucketed")).read("base").where("status = 'NEW'").isEmpty()


def test_a_busy_row_key_lies_in_several_buckets(spark):
    rows = spark.range(3000).select(
        *[F.lit("x").alias(c) for c in ROW_KEY], F.lit("M1").alias("code"), F.col("id").cast("string").alias("value"),
        F.lit(1).cast("long").alias("cnt"), F.lit(0).cast("long").alias("first_time"), F.lit(0).cast("long").alias("last_time"),
        F.lit(1).alias("day_cnt"), F.create_map(F.lit(19700101), F.lit(1).cast("long")).alias("days"),
    )
    store = BucketedProfiles(spark, work_dir(spark, "bucketed"), 8, 16).build(rows)
    files = store.read("base").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(files) > 3 and max(r["count"] for r in files) < 1500
    merged = store.merge(rows.limit(1), work_dir(spark, "bucketed")).read("base")
    assert merged.where("status = 'UPDATE'").count() == 3000 and merged.agg(F.sum("cnt")).first()[0] == 3001


def test_buckets_grow_with_the_rows():
    assert buckets_for(10, 8) == 8
    assert buckets_for(8 * BUCKET_ROWS + 1, 8) == 9
    assert buckets_for(1000 * BUCKET_ROWS, 8) == 1000
