"""Merged profiles with the status of their row key, and what their plans move."""

from pyspark.sql import functions as F

from dossierlake.operators import fold, merge
from dossierlake.plans import profiles as plan
from dossierlake.schema import ROW_KEY
from dossierlake.session import materialize

DAYS = (
    "entity_type string, oid string, data_source string, protocol string, action string, code string, value string, "
    "day int, n bigint, first_time bigint, last_time bigint, latest decimal(38,0), arrival decimal(38,0)"
)


def day_table(spark, oids, days):
    rows = spark.createDataFrame([(o, v, d) for o in oids for v in range(9) for d in days], "o int, v int, d int")
    text = {c: F.lit("x") for c in ("entity_type", "data_source", "protocol", "action", "code")}
    rows = rows.withColumns(text | {"oid": F.col("o").cast("string"), "value": F.col("v").cast("string")})
    time = F.col("d").cast("bigint") * 86400
    rows = rows.withColumns({"day": F.col("d"), "n": F.lit(1).cast("bigint"), "first_time": time, "last_time": time})
    rank = time.cast("decimal(38,0)")
    rows = rows.withColumns({"latest": rank, "arrival": rank})
    return materialize(rows.select(*[c.split()[0] for c in DAYS.split(", ")]), "days")


def rows_of(frame):
    flat = frame.withColumn("days", fold.days_text(F.col("days")))
    return sorted(map(repr, flat.select(sorted(flat.columns)).collect()))


def test_status_of_busy_and_other_row_keys(spark):
    old, new = day_table(spark, range(8), (1, 2)), day_table(spark, range(5, 12), (2, 3))
    whole = fold.base_profile(fold.merge_attr_day(old, new)).join(merge.classify(old, new), ROW_KEY)
    for busy in (4, 10**6):
        assert rows_of(plan.merged_with_status(old, new, busy)) == rows_of(whole)


def test_day_rows_move_once(spark):
    """The merged side is neither dealt out nor sorted again for the status."""
    merged = plan.merged_with_status(day_table(spark, range(8), (1, 2)), day_table(spark, range(5, 12), (2, 3)))
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2, text


def test_a_stream_folds_no_file_in_one_task(spark, out, monkeypatch):
    from dossierlake.plans.store import SnapshotStore
    from dossierlake.sources import streams
    from dossierlake.streaming import merge as stream_merge
    from tests.test_fold import DICTIONARY, WIDE, observations

    spark.createDataFrame(observations(5), WIDE).coalesce(1).write.parquet(out("in"))
    parts, rows = [], stream_merge.attribute_rows
    monkeypatch.setattr(stream_merge, "attribute_rows", lambda obs, d: parts.append(obs.rdd.getNumPartitions()) or rows(obs, d))
    source, store = streams.file_stream(spark, out("in"), WIDE), SnapshotStore(spark, out("store"), buckets=4)
    stream_merge.start_change_feed(source, store, DICTIONARY, out("feed"), out("cp"), "f").awaitTermination(120)
    assert parts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
