"""Keyed streaming state: seeded, restarted, replayed."""

from pyspark.sql import functions as F

from dossierlake.operators.fold import ATTR_DAY, fold_attr_day
from dossierlake.plans.profiles import attribute_rows
from dossierlake.sources import adapters, streams
from dossierlake.sources.adapters import DICTIONARY
from dossierlake.streaming import keyed

SMALL = "/root/testdata/sf0.001"


def day_table(obs):
    return fold_attr_day(attribute_rows(obs, DICTIONARY))


def run(spark, path, schema, out, seed=None):
    query = keyed.start_keyed(
        streams.file_stream(spark, path, schema), DICTIONARY, "attr_day", out("changes"), out("cp"), seed=seed
    )
    query.processAllAvailable()
    query.awaitTermination()
    return query


def same(left, right):
    rows = [sorted(map(tuple, f.select(*ATTR_DAY).collect()), key=repr) for f in (left, right)]
    return rows[0] == rows[1]


def test_seeded_state_survives_a_restart(spark, out):
    obs = adapters.load_events(spark, SMALL)
    old, new = adapters.split_stored(obs, adapters.EVENTS_SPLIT)
    day_table(old).write.parquet(out("seed"))
    seed = lambda: streams.file_stream(spark, out("seed"), day_table(old).schema)
    new.where("seq % 3 <> 0").write.parquet(out("in"))
    query = run(spark, out("in"), obs.schema, out, seed())
    assert "RocksDB" in str(query.lastProgress["stateOperators"][0]["customMetrics"]) or any(
        "rocksdb" in k for k in query.lastProgress["stateOperators"][0]["customMetrics"]
    )
    assert spark.conf.get(keyed.PROVIDER) != keyed.ROCKSDB
    first = keyed.current_rows(spark, out("changes"), "attr_day")
    assert same(first, day_table(old.unionByName(new.where("seq % 3 <> 0"))))
    new.where("seq % 3 = 0").write.mode("append").parquet(out("in"))
    run(spark, out("in"), obs.schema, out, seed())
    assert same(keyed.current_rows(spark, out("changes"), "attr_day"), day_table(obs))
    # The second run wrote only the keys that it touched.
    last = spark.read.parquet(out("changes"))
    last = last.where(F.col("batch_id") == last.agg(F.max("batch_id")).first()[0])
    assert last.count() == day_table(new.where("seq % 3 = 0")).count()


def test_a_replayed_batch_counts_once(spark, out):
    obs = adapters.load_events(spark, SMALL)
    obs.write.parquet(out("in"))
    run(spark, out("in"), obs.schema, out)
    import os

    commits = os.path.join(out("cp"), "commits")
    newest = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    os.replace(os.path.join(commits, newest), out("taken-away"))
    crc = os.path.join(commits, f".{newest}.crc")
    if os.path.exists(crc):
        os.replace(crc, out("taken-away.crc"))
    run(spark, out("in"), obs.schema, out)
    assert same(keyed.current_rows(spark, out("changes"), "attr_day"), day_table(obs))
