"""Queries that write and read back: ingest, snapshot store, generation, streams.

Each one works on a whole table, through files in a fresh folder of the shared working
folder, and returns what a reader of the written result sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary
from dossierlake.functions.keys import entity_key
from dossierlake.functions.times import time_text
from dossierlake.operators import assemble, attributes, documents, fold, lookup
from dossierlake.plans import profiles as plan
from dossierlake.plans import footers, runlog
from dossierlake.plans.queries import oracle as q
from dossierlake.plans.queries.common import BUCKETS, SPLITS, attr_sides, flat, fresh_store, sides
from dossierlake.plans.store import SnapshotStore, parquet_codec
from dossierlake.schema import ATTR_KEY, ENTITY, ROW_KEY
from dossierlake.session import work_dir
from dossierlake.sources import adapters, generator, paths, streams, tagged_tsv
from dossierlake.sources.adapters import DICTIONARY, load_events, load_lines, table
from dossierlake.streaming import keyed, sinks
from dossierlake.streaming import lookup as stream_lookups
from dossierlake.streaming import merge as stream_merge

TSV_COLUMNS = {
    "A010001": "entity_type", "A010002": "oid", "H010014": "time", "B050016": "data_source",
    "H010001": "protocol", "H010003": "action", "B010001": "S1", "B010011": "S2",
    "B010007": "M1",
}
TSV_DICTIONARY = AttrDictionary.default()
GENERATOR = generator.GeneratorConfig(day_start=1388534400, seed="7", id_num=1000)

# -- tagged files ---------------------------------------------------------------------


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = load_events(spark, sf_dir).withColumn("time", time_text(F.col("capture_time")))
    return obs.select(*[F.col(name).alias(code) for code, name in TSV_COLUMNS.items()])


def _write_tagged(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = work_dir(spark, name)
    tagged_tsv.write_tagged(_coded(spark, sf_dir), path, list(TSV_COLUMNS))
    return path


def tagged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_tagged(spark, sf_dir, "tagged")
    scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY)
    rows = attributes.explode_props(scan.observations, distinct=False)
    return rows.select(*ROW_KEY, "capture_time", "code", "value")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines broken in four ways, by event number."""
    n = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events")
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    cells = [
        F.lit("user"),
        F.when(n % 5 == 1, "").otherwise(F.col("user_id").cast("string")),
        F.when(n % 5 == 2, "not a time").otherwise(when),
        F.col("event_type"),
        F.lit("p"),
        F.when(n % 5 == 3, F.lit("a\tb\tc\td\te")).otherwise("a"),
    ]
    line = F.when(n % 5 == 4, F.lit("user\t1")).otherwise(
        F.concat_ws("\t", *cells, F.lit("x"), F.lit("1"), F.lit(""))
    )
    path = work_dir(spark, "broken")
    tagged_tsv.write_lines(events.select(line.alias("value")), path, list(TSV_COLUMNS))
    scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY, layout=list(TSV_COLUMNS))
    bad = scan.quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))
    good = scan.observations.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("cnt"))
    return bad.unionByName(good)


def record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_tagged(spark, sf_dir, "counted")
    scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY, layout=list(TSV_COLUMNS))
    return scan.observations.agg(F.count(F.lit(1)).alias("records"))


def keyed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_tagged(spark, sf_dir, "upload")
    scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY, layout=list(TSV_COLUMNS))
    out = work_dir(spark, "keyed")
    keyed = scan.observations.withColumn(
        "entity_key", entity_key(F.col("entity_type"), F.col("oid"))
    )
    keyed.write.mode("errorifexists").parquet(out)
    return (
        spark.read.parquet(out)
        .groupBy("entity_key", "data_source")
        .agg(F.count(F.lit(1)).alias("records"), F.sum(F.size("props")).alias("attributes"))
    )


def one_step_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tagged loads into one store; info attributes and how many documents came out."""
    store = fresh_store(spark, "load")
    docs = work_dir(spark, "load-docs")
    coded = _coded(spark, sf_dir)
    early = F.unix_timestamp("H010014") < SPLITS["e"]
    for name, part in (("old", coded.where(early)), ("new", coded.where(~early))):
        path = work_dir(spark, f"load-{name}")
        tagged_tsv.write_tagged(part, path, list(TSV_COLUMNS))
        scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY, layout=list(TSV_COLUMNS))
        plan.load(store, scan.observations, TSV_DICTIONARY, name, 0, f"{docs}/{name}", True)
    info = plan.stored_profiles(store, TSV_DICTIONARY).info_attr
    values = info.groupBy("code").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("last_time").alias("times")
    )
    counts = [
        spark.read.text(f"{docs}/new/{kind}").agg(
            F.lit(f"documents {kind}").alias("code"),
            F.count(F.lit(1)).alias("cnt"),
            F.lit(0).cast("bigint").alias("times"),
        )
        for kind in ("base", "info")
    ]
    return values.unionByName(counts[0]).unionByName(counts[1])


def arrival_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tagged loads whose rows share their days: ties and late rows across batches."""
    store = fresh_store(spark, "arrivals")
    obs = load_events(spark, sf_dir)
    day = F.date_trunc("day", F.timestamp_seconds("capture_time"))
    obs = obs.withColumn("time", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    for batch in range(3):
        part = obs.where(F.col("seq") % 3 == batch).orderBy("seq")
        path = work_dir(spark, f"arrival-{batch}")
        coded = part.select(*[F.col(name).alias(code) for code, name in TSV_COLUMNS.items()])
        tagged_tsv.write_tagged(coded, path, list(TSV_COLUMNS))
        scan = tagged_tsv.scan_tagged(spark, path, TSV_DICTIONARY, layout=list(TSV_COLUMNS))
        plan.ingest(store, scan.observations, TSV_DICTIONARY, f"b{batch}", by_batch=True)
    return plan.stored_profiles(store, TSV_DICTIONARY).info_attr


def load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that died between store and documents is repeated after a later batch came in."""
    store = fresh_store(spark, "retry")
    old, new = adapters.split_stored(load_events(spark, sf_dir), SPLITS["e"])
    plan.ingest(store, old, DICTIONARY, "old")
    plan.ingest(store, new, DICTIONARY, "new")
    plan.ingest(store, old.limit(1).withColumn("oid", F.lit("other")), DICTIONARY, "later")
    docs = work_dir(spark, "retry-docs")
    plan.load(store, new, DICTIONARY, "new", 0, docs)
    lines = spark.read.text(f"{docs}/base")
    fields = [documents.FIELD_OID, documents.FIELD_DATA_SOURCE, documents.FIELD_PROTOCOL,
              documents.FIELD_ACTION]
    doc = F.from_json("value", "id string, page bigint, H010014 bigint, A010001 string, "
                      "A010002 string, B050016 string, H010001 string, H010003 string, "
                      "props array<map<string,string>>")
    text = F.transform("doc.props", lambda p: F.concat(F.map_keys(p)[0], F.lit("="), F.map_values(p)[0]))
    read = lines.select(doc.alias("doc")).select("*", F.array_join(text, ";").alias("props"))
    return read.select("doc.id", *[f"doc.{f}" for f in fields], "props")


def delete_base_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base profiles go, info profiles of the same entities stay readable."""
    store = fresh_store(spark, "delete-base")
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    plan.ingest(store, old, DICTIONARY, "old")
    plan.ingest(store, new, DICTIONARY, "new")
    plan.delete_entities(store, new.select(*ENTITY), "gone", base=True, info=False)
    left = plan.stored_profiles(store, DICTIONARY)
    base = left.base.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("value_rows"))
    info = flat(left.info).select(*ENTITY, "cnt", "days")
    return info.join(base, ENTITY, "left")


def mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the layout, with two columns swapped and without a header."""
    root = work_dir(spark, "mixed")
    coded = _coded(spark, sf_dir)
    names = list(TSV_COLUMNS)
    swapped = [*names[:4], names[5], names[4], *names[6:]]
    source = F.col("B050016")
    tagged_tsv.write_tagged(coded.where(source == "click"), f"{root}/a", names)
    tagged_tsv.write_tagged(coded.where(source == "view"), f"{root}/b", swapped)
    assemble.delimited(coded.where(~source.isin("click", "view")), names, "\t").write.text(f"{root}/c")
    scan = tagged_tsv.scan_tagged(spark, [f"{root}/{x}" for x in "abc"], TSV_DICTIONARY, layout=names)
    good = scan.observations.groupBy("data_source").agg(F.count(F.lit(1)).alias("cnt"))
    bad = scan.quarantine.where(~F.col("value").startswith("@")).groupBy("reason")
    return good.unionByName(
        bad.agg(F.count(F.lit(1)).alias("cnt")).withColumnRenamed("reason", "data_source")
    )


def store_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose input patterns match nothing goes on with the store."""
    root = work_dir(spark, "store-only")
    load_lines(spark, sf_dir).write.parquet(f"{root}/store/part-old")
    rows = paths.read_merge_inputs(spark, f"{root}/in/*", f"{root}/store/part-*")
    return rows.groupBy("src", "data_source").agg(F.count(F.lit(1)).alias("cnt"))


# -- files and the store --------------------------------------------------------------


def multi_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "globs")
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    old.write.parquet(f"{root}/store/part-old")
    new.where("action = 'F'").write.parquet(f"{root}/in/day1")
    new.where("action <> 'F'").write.parquet(f"{root}/in/day2")
    rows = paths.read_merge_inputs(
        spark,
        f"{root}/in/day*, {root}/none/*",
        f"{root}/store/part-*,{root}/gone",
    )
    return rows.groupBy("src", "data_source").agg(F.count(F.lit(1)).alias("cnt"))


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fresh_store(spark, "snapshot")
    plan.ingest(store, load_events(spark, sf_dir), DICTIONARY, "all")
    return flat(fold.base_profile(store.read("attr_day")))


def incremental_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base profiles of version 1 (stored part) and of the head (after the new part)."""
    store = fresh_store(spark, "versions")
    for name, part in zip(("old", "new"), adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])):
        plan.ingest(store, part, DICTIONARY, name)
    versions = [
        plan.stored_profiles(store, DICTIONARY, v)
        .base.groupBy("data_source", "code")
        .agg(F.count(F.lit(1)).alias("value_rows"), F.sum("cnt").alias("cnt"))
        .withColumn("version", F.lit(v).cast("bigint"))
        for v in (1, 2)
    ]
    return versions[0].unionByName(versions[1])


def codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = load_events(spark, sf_dir)
    result = None
    for name in ("none", "SnappyCodec", "gzip", "zstd", "unknown"):
        path = work_dir(spark, f"codec-{name}")
        obs.write.option("compression", parquet_codec(name)).parquet(path)
        part = spark.read.parquet(path).agg(
            F.lit(name).alias("codec"),
            F.count(F.lit(1)).alias("cnt"),
            F.sum("capture_time").alias("times"),
        )
        result = part if result is None else result.unionByName(part)
    return result


def info_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fresh_store(spark, "lookup")
    plan.ingest(store, load_events(spark, sf_dir), DICTIONARY, "all")
    match = lookup.entity_filter(store.read("attr_day"), "user", "8", store.buckets)
    found = plan.find_in_store(store, match, DICTIONARY)
    return found.info_attr.join(flat(found.info).select(*ENTITY, "cnt", "days"), ENTITY)


def delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop every customer that has an urgent order line returned."""
    store = fresh_store(spark, "delete")
    obs = load_lines(spark, sf_dir)
    plan.ingest(store, obs, DICTIONARY, "all")
    keys = obs.where("S1 = '1-URGENT' AND data_source = 'R'").select(*ENTITY)
    plan.delete_entities(store, keys, "gone")
    left = plan.stored_profiles(store, DICTIONARY)
    base = left.base.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("value_rows"))
    return base.join(left.info.select(*ENTITY, "cnt"), ENTITY, "full")


def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving table filled with the stored profiles, then upserted with the changed ones."""
    old, new = attr_sides(spark, sf_dir, "o")
    serving = fresh_store(spark, "serving")
    plan.export_changed(serving, None, old, "first")
    plan.export_changed(serving, old, new, "second")
    return flat(serving.read("base").drop("bucket"))


def info_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for info profiles."""
    old, new = (side["entity_day"] for side in sides(spark, sf_dir, "o"))
    serving = fresh_store(spark, "serving-info")
    plan.export_changed_info(serving, None, old, "first")
    plan.export_changed_info(serving, old, new, "second")
    return flat(serving.read("info").drop("bucket"))


def info_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = sides(spark, sf_dir, "o")
    path = f"{work_dir(spark, 'merged-info')}/day"
    plan.merge_info_snapshots(old, new, path)
    return flat(spark.read.parquet(path))


def many_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info attributes of every customer with an urgent returned line, in one job."""
    store = fresh_store(spark, "lookup-many")
    obs = load_lines(spark, sf_dir)
    for name, part in zip(("old", "new"), adapters.split_stored(obs, SPLITS["o"])):
        plan.ingest(store, part, DICTIONARY, name)
    keys = obs.where("S1 = '1-URGENT' AND data_source = 'R'").select(*ENTITY)
    found = plan.find_many_in_store(store, keys, DICTIONARY)
    return found.info_attr.join(flat(found.info).select(*ENTITY, "cnt", "days"), ENTITY)


def status_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = ({"attr_day": side} for side in attr_sides(spark, sf_dir, "o"))
    path = f"{work_dir(spark, 'merged')}/day"
    plan.merge_snapshots(old, new, path)
    return (
        spark.read.parquet(path)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("value_rows"), F.sum("cnt").alias("cnt"))
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "runlog")
    obs = load_lines(spark, sf_dir)

    def job() -> dict[str, int]:
        return runlog.write_counted(
            obs,
            f"{root}/out",
            {
                "rows.written": F.count(F.lit(1)),
                "rows.key.urgent": F.sum(F.when(F.col("S1") == "1-URGENT", 1).otherwise(0)),
                "rows.open": F.sum(F.when(F.col("action") == "O", 1).otherwise(0)),
                "bytes.text": F.sum(F.length("M1")),
            },
        )

    runlog.run_logged(spark, f"{root}/log", "copy lines", job)
    lines = runlog.counter_lines(spark.read.parquet(f"{root}/log"))
    return lines.drop("job_id")


def counter_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of one job per order status, each with its place in the sorted line."""
    root = work_dir(spark, "counters")
    obs = load_lines(spark, sf_dir)
    groups = ("seen.in", "dated")
    names = [f"{group}.{status}" for group in groups for status in ("O", "F", "P")]

    def job() -> dict[str, int]:
        of = {s: F.col("action") == s for s in ("O", "F", "P")}
        measures = {
            name: F.count_if(of[name[-1]])
            if name.startswith("seen")
            else F.max(F.when(of[name[-1]], F.col("capture_time")))
            for name in names
        }
        return runlog.write_counted(obs, f"{root}/out", measures)

    runlog.run_logged(spark, f"{root}/log", "count lines", job)
    line = runlog.sorted_counters(spark.read.parquet(f"{root}/log"))
    return flat(line.drop("job_id", "job_name"))


def printed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the console shows of every observation, with its sequence number."""
    obs = attributes.collect_props(load_events(spark, sf_dir), DICTIONARY)
    path, out = work_dir(spark, "print"), work_dir(spark, "print-out")
    obs.write.parquet(path)
    shown = assemble.show_observations(streams.file_stream(spark, path, obs.schema))
    _finish(sinks.write_rolled_stream(shown, out, work_dir(spark, "print-cp")))
    return flat(spark.read.parquet(out))


def delimited_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "delimited")
    assemble.delimited(load_events(spark, sf_dir), ["seq", "oid", "M1"]).write.text(path)
    return spark.read.text(path)


# -- generated observations -------------------------------------------------------------


def _props_text() -> Column:
    return F.array_join(F.transform("props", lambda p: F.concat(p["code"], F.lit("="), p["value"])), ";")


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select("o_orderkey")
    obs = generator.generate(ids, GENERATOR, "o_orderkey")
    return obs.withColumn("props", _props_text())


def generation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one generated observation per order; what was written and the summary."""
    path = f"{work_dir(spark, 'generated')}/day"
    ids = table(spark, sf_dir, "orders").select("o_orderkey").repartition(4)
    summary = generator.write_generated(generator.generate(ids, GENERATOR, "o_orderkey"), path)
    written = spark.read.parquet(path).groupBy(F.col("entity_type").alias("what")).agg(
        F.count(F.lit(1)).alias("records")
    )
    total = summary.select(F.lit("summary").alias("what"), F.col("total_records").alias("records"))
    return written.unionByName(total)


# -- streams ----------------------------------------------------------------------------


def _event_files(spark: SparkSession, sf_dir: str, name: str, files: int = 4) -> tuple[DataFrame, str]:
    """The wide observations of the events table as files, for a file stream to read."""
    obs = load_events(spark, sf_dir)
    path = work_dir(spark, name)
    obs.repartition(files, "seq").write.parquet(path)
    return obs, path


def _messages(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    """The observations as queue messages (key, value bytes, timestamp, offset) in files."""
    obs = attributes.collect_props(load_events(spark, sf_dir), DICTIONARY)
    path = work_dir(spark, name)
    messages = streams.encode_messages(obs).withColumns(
        {
            "offset": F.get_json_object(F.col("value").cast("string"), "$.seq").cast("bigint"),
            "timestamp": F.timestamp_millis(F.lit(0)),
        }
    )
    messages.repartition(4, "offset").write.parquet(path)
    return spark.read.parquet(path), path


def _finish(query) -> None:
    query.processAllAvailable()
    query.awaitTermination()


def queue_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, path = _messages(spark, sf_dir, "queue")
    out = work_dir(spark, "decoded")
    stream = streams.decode_messages(streams.file_stream(spark, path, frame.schema))
    _finish(sinks.write_rolled_stream(stream, out, work_dir(spark, "queue-cp")))
    return spark.read.parquet(out).withColumn("props", _props_text())


def throttled_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated observation per order, a bounded number of files per trigger."""
    ids = table(spark, sf_dir, "orders").select("o_orderkey")
    path, out = work_dir(spark, "ids"), work_dir(spark, "throttled")
    ids.repartition(3).write.parquet(path)
    stream = streams.file_stream(spark, path, ids.schema, max_files_per_trigger=1)
    obs = generator.generate(stream, GENERATOR, "o_orderkey")
    _finish(sinks.write_rolled_stream(obs, out, work_dir(spark, "throttled-cp")))
    return spark.read.parquet(out).withColumn("props", _props_text())


def throttled_consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, path = _messages(spark, sf_dir, "consumed")
    out = work_dir(spark, "printed")
    stream = streams.decode_messages(
        streams.file_stream(spark, path, frame.schema, max_files_per_trigger=1)
    )
    shown = assemble.show_observations(stream)
    _finish(sinks.write_batch_folders(shown, out, work_dir(spark, "consumed-cp")))
    return flat(spark.read.parquet(out)).drop("batch_id")


def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, path = _event_files(spark, sf_dir, "collect")
    out = work_dir(spark, "collected")
    stream = sinks.keyed_messages(streams.file_stream(spark, path, obs.schema))
    _finish(sinks.write_rolled_stream(stream, out, work_dir(spark, "collect-cp")))
    return spark.read.parquet(out).select(
        "key",
        F.get_json_object("value", "$.seq").cast("bigint").alias("seq"),
        F.get_json_object("value", "$.M1").alias("M1"),
    )


def rotation_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files cut at 1 KB of 8-byte records: no file above 128 rows, nothing lost."""
    obs, path = _event_files(spark, sf_dir, "rotate")
    out = work_dir(spark, "rotated")
    stream = streams.file_stream(spark, path, obs.schema).select("seq")
    rotation = sinks.Rotation.by_size(1, "KB", record_bytes=8)
    _finish(sinks.write_rolled_stream(stream, out, work_dir(spark, "rotate-cp"), rotation))
    files = (
        spark.read.parquet(out)
        .select("seq", "_metadata.file_path")
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs"))
    )
    return files.agg(
        F.sum("n").alias("cnt"),
        F.sum("seqs").alias("seqs"),
        F.sum((F.col("n") > rotation.max_records).cast("bigint")).alias("too_long"),
    )


def dated_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, path = _event_files(spark, sf_dir, "dated")
    out = work_dir(spark, "by-date")
    stream = sinks.with_date(
        streams.file_stream(spark, path, obs.schema), F.col("capture_time")
    )
    _finish(
        sinks.write_rolled_stream(stream, out, work_dir(spark, "dated-cp"), partition_by=["dt"])
    )
    return (
        spark.read.parquet(out)
        .groupBy(F.col("dt").cast("string").alias("dt"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("seq").alias("seqs"))
    )


def post_close_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stage reads the finished files and has them moved to an archive."""
    obs, path = _event_files(spark, sf_dir, "stage")
    first, second = work_dir(spark, "stage-out"), work_dir(spark, "stage-next")
    stream = streams.file_stream(spark, path, obs.schema)
    _finish(sinks.write_batch_folders(stream, first, work_dir(spark, "stage-cp1")))
    following = streams.file_stream(
        spark, first, obs.schema, archive_dir=work_dir(spark, "stage-archive")
    )
    _finish(sinks.write_rolled_stream(following, second, work_dir(spark, "stage-cp2")))
    return spark.read.parquet(second).select("seq", "oid", "M1")


def stream_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, path = _event_files(spark, sf_dir, "text")
    out = work_dir(spark, "text-out")
    stream = streams.file_stream(spark, path, obs.schema)
    _finish(
        sinks.write_rolled_stream(
            stream, out, work_dir(spark, "text-cp"), fmt="text", fields=["seq", "oid", "M1"]
        )
    )
    return spark.read.text(out)


def _merged_from_stream(spark: SparkSession, sf_dir: str, name: str, per_trigger: int = 1) -> SnapshotStore:
    obs, path = _event_files(spark, sf_dir, name, files=2)
    store = fresh_store(spark, f"{name}-store")
    stream = streams.file_stream(spark, path, obs.schema, max_files_per_trigger=per_trigger)
    _finish(
        stream_merge.start_profile_merge(
            stream, store, DICTIONARY, work_dir(spark, f"{name}-cp"), name
        )
    )
    return store


def stream_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _merged_from_stream(spark, sf_dir, "str1")
    return flat(plan.stored_profiles(store, DICTIONARY).base)


def stream_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _merged_from_stream(spark, sf_dir, "str2")
    return plan.stored_profiles(store, DICTIONARY).info_attr


def _keyed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Stored rows seed the state; the stream stops after its first half and starts again."""
    old, new = adapters.split_stored(load_events(spark, sf_dir), SPLITS["e"])
    stored = plan.day_tables(old, DICTIONARY)[table]
    seed, path = work_dir(spark, "keyed-seed"), work_dir(spark, "keyed-in")
    changes, checkpoint = work_dir(spark, "keyed-out"), work_dir(spark, "keyed-cp")
    stored.write.parquet(seed)
    for half in range(2):
        new.where(F.col("seq") % 2 == half).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, new.schema)
        _finish(
            keyed.start_keyed(
                stream, DICTIONARY, table, changes, checkpoint,
                seed=streams.file_stream(spark, seed, stored.schema),
            )
        )
    return keyed.current_rows(spark, changes, table)


def keyed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fold.base_profile(_keyed(spark, sf_dir, "attr_day")))


def keyed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fold.info_profile(_keyed(spark, sf_dir, "entity_day")))


def keyed_info_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.info_attributes(_keyed(spark, sf_dir, "attr_day"), DICTIONARY)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value once, in the feed of the batch that saw it first."""
    obs, path = _event_files(spark, sf_dir, "feed", files=2)
    feed = work_dir(spark, "feed-out")
    stream = streams.file_stream(spark, path, obs.schema, max_files_per_trigger=1)
    _finish(
        stream_merge.start_change_feed(
            stream, fresh_store(spark, "feed-store"), DICTIONARY, feed,
            work_dir(spark, "feed-cp"), "feed",
        )
    )
    return spark.read.parquet(feed).select(*ATTR_KEY)


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed from streaming state alone."""
    obs, path = _event_files(spark, sf_dir, "seen", files=2)
    out = work_dir(spark, "seen-out")
    stream = streams.file_stream(spark, path, obs.schema, max_files_per_trigger=1)
    _finish(
        sinks.write_rolled_stream(
            stream_merge.first_seen(stream, DICTIONARY), out, work_dir(spark, "seen-cp")
        )
    )
    return spark.read.parquet(out)


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches delivered again (a lost checkpoint): the store counts them once."""
    obs, path = _event_files(spark, sf_dir, "replay", files=2)
    store = fresh_store(spark, "replay-store")
    for attempt in ("a", "b"):
        stream = streams.file_stream(spark, path, obs.schema)
        _finish(
            stream_merge.start_profile_merge(
                stream, store, DICTIONARY, work_dir(spark, f"replay-cp-{attempt}"), "replay"
            )
        )
    return flat(plan.stored_profiles(store, DICTIONARY).info)


class _Interrupted(SnapshotStore):
    """Fails once in each gap of a batch: its segments written but not listed, listed but not
    yet noted in the stream's checkpoint."""

    gaps = ("unlisted", "unnoted")

    def _commit(self, head, segments, batch_id):
        if self.gaps == _Interrupted.gaps:
            self.gaps = self.gaps[1:]
            raise RuntimeError("stopped before the commit")
        version = super()._commit(head, segments, batch_id)
        if self.gaps and version > 1:
            self.gaps = ()
            raise RuntimeError("stopped after the commit")
        return version


def recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checkpoint through two failures, one in each gap: every observation counts once."""
    obs, path = _event_files(spark, sf_dir, "recovery", files=3)
    store = _Interrupted(spark, work_dir(spark, "recovery-store"), BUCKETS)
    checkpoint = work_dir(spark, "recovery-cp")

    def start():
        stream = streams.file_stream(spark, path, obs.schema, max_files_per_trigger=1)
        return stream_merge.start_profile_merge(stream, store, DICTIONARY, checkpoint, "recovery")

    restarts = stream_merge.run_to_end(start)
    info = flat(plan.stored_profiles(store, DICTIONARY).info)
    return info.withColumn("restarts", F.lit(restarts).cast("bigint"))


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, each looked up in the store that the earlier ones have entered."""
    obs = load_events(spark, sf_dir)
    store = fresh_store(spark, "stream-lookup")
    path, found, checkpoint = (work_dir(spark, f"stream-lookup-{x}") for x in ("in", "out", "cp"))
    for part in range(3):
        obs.where(F.col("seq") % 3 == part).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, obs.schema)
        _finish(
            stream_lookups.start_stored_lookup(
                stream, store, found, checkpoint, "lookup", merge_with=DICTIONARY
            )
        )
    return flat(spark.read.parquet(found))


def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of day rows and of last sightings per source, counted from footers."""
    store = fresh_store(spark, "footer-counts")
    for name, half in zip(("old", "new"), adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])):
        seen = half.groupBy(*ENTITY).agg(
            *[F.max(F.when(F.col("data_source") == x, F.col("capture_time"))).alias(f"seen_{x}") for x in "ANR"]
        )
        days = plan.day_tables(half, DICTIONARY)["entity_day"].select(*ENTITY, "day", "n")
        store.append({"seen": seen, "days": days}, name)
    return flat(footers.count_cells(store, ["seen", "days"]))


def batch_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, path = _event_files(spark, sf_dir, "batches", files=3)
    out = work_dir(spark, "batches-out")
    stream = streams.file_stream(spark, path, obs.schema, max_files_per_trigger=1)
    _finish(sinks.write_batch_folders(stream, out, work_dir(spark, "batches-cp")))
    written = spark.read.parquet(out)
    return written.agg(
        F.count_distinct("batch_id").alias("batches"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("seq").alias("seqs"),
    )


def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New observations arrive first, the stored half a batch later."""
    store = fresh_store(spark, "late-store")
    checkpoint, path = work_dir(spark, "late-cp"), work_dir(spark, "late")
    old, new = adapters.split_stored(load_events(spark, sf_dir), SPLITS["e"])
    for part in (new, old):
        part.write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, part.schema)
        _finish(
            stream_merge.start_profile_merge(stream, store, DICTIONARY, checkpoint, "late")
        )
    return flat(plan.stored_profiles(store, DICTIONARY).base)


# -- SQL --------------------------------------------------------------------------------

_E = q.fixture("e")
_O = q.fixture("o")
_BASE = f"{q.KEY}, code, value, cnt, first_time, last_time, day_cnt, days"
_E_BASE = f"{_E}, {q.base('e_attr', 'b')} SELECT {_BASE} FROM b"
_CODE = "CASE code WHEN 'S1' THEN 'B010001' WHEN 'S2' THEN 'B010011' ELSE 'B010007' END"
_SUMS = "count(*) AS value_rows, CAST(sum(cnt) AS BIGINT) AS cnt"


def _pick_sql(digest: str, start: int, digits: int, options: list[str]) -> str:
    items = ", ".join(f"'{o}'" for o in options)
    number = q.hex_number(f"substr({digest}, {start + 1}, {digits})")
    return f"list_extract([{items}], CAST({number} % {len(options)} AS INTEGER) + 1)"


def _generated_sql() -> str:
    g = GENERATOR
    codes = [(c, g.single_suffixes) for c in g.single_codes]
    codes += [(c, g.multi_suffixes) for c in g.multi_codes]
    props = " || ';' || ".join(
        f"'{code}=' || md5(entity_type || oid || '{code}') || {_pick_sql('v', 3 * i, 3, suffixes)}"
        for i, (code, suffixes) in enumerate(codes)
    )
    return (
        f"WITH d AS (SELECT o_orderkey AS seq, md5('{g.seed}|' || o_orderkey) AS h, "
        f"md5('{g.seed}|' || o_orderkey || '|v') AS v FROM orders), g AS (SELECT "
        f"{_pick_sql('h', 8, 4, g.types)} AS entity_type, "
        f"CAST({g.id_start} + {q.hex_number('substr(h, 1, 8)')} % {g.id_num} AS VARCHAR) AS oid, "
        f"{_pick_sql('h', 12, 2, g.data_sources)} AS data_source, "
        f"{_pick_sql('h', 14, 2, g.protocols)} AS protocol, "
        f"{_pick_sql('h', 16, 2, g.actions)} AS action, "
        f"{g.day_start} + {q.hex_number('substr(h, 19, 7)')} % 86400 AS capture_time, seq, v "
        f"FROM d), obs AS (SELECT {q.HEADER}, {props} AS props FROM g)"
    )


_GENERATED = f"{_generated_sql()} SELECT {q.HEADER}, props FROM obs"
_E_PROPS = "'S1=' || S1 || ';S2=' || S2 || ';M1=' || replace(M1, ',', ';M1=')"
_CELLS = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {q.bucket(8)} AS bucket, "
    f"{'1' if c == '*' else c} AS cell FROM {t}"
    for t, columns in (
        ("seen", "* entity_type oid seen_A seen_N seen_R"), ("days", "* entity_type oid day n"),
    )
    for c in columns.split()
).replace("AS cell", "IS NOT NULL AS cell")
_FOOTER_SQL = (
    f"{_O}, {q.sides('o')}, halves AS (SELECT *, capture_time < {q.SPLIT['o']} AS half FROM o_obs), "
    "seen AS (SELECT entity_type, oid, "
    + ", ".join(f"max(capture_time) FILTER (data_source = '{x}') AS seen_{x}" for x in "ANR")
    + f" FROM halves GROUP BY entity_type, oid, half), days AS (SELECT entity_type, oid, {q.day()} "
    f"AS day, count(*) AS n FROM halves GROUP BY entity_type, oid, 3, half), cells AS ({_CELLS}) "
    "SELECT \"table\", \"column\", bucket, CAST(count_if(cell) AS BIGINT) AS n FROM cells "
    "GROUP BY GROUPING SETS ((\"table\", \"column\", bucket), (\"table\", \"column\"))"
)
_E_ATTRS = f"{_E} SELECT DISTINCT {q.KEY}, code, value FROM e_attr"
_SHOWN = (
    f"{q.HEADER}, {q.ENTITY_KEY} AS md5, CAST(5 AS BIGINT) AS n_props, "
    "'S1=' || S1 || ',S2=' || S2 || ',M1=' || replace(M1, ',', ',M1=') AS props"
)

_ARRIVALS = q.E_OBS.replace(
    "epoch_us(ts) // 1000000 AS capture_time, event_id AS seq",
    "epoch_us(date_trunc('day', ts)) // 1000000 AS capture_time, "
    "(event_id % 3) * 1000000000000 + event_id AS seq",
)

QUERIES = {
    "src1_tagged_scan": (
        tagged_scan,
        f"{q.fixture('e', True)} SELECT {q.KEY}, capture_time, {_CODE} AS code, value FROM e_attr",
    ),
    "src2_quarantine": (
        quarantine,
        "SELECT CASE CAST(json_extract(props, '$.k') AS BIGINT) % 5 WHEN 1 THEN 'no entity id' "
        "WHEN 2 THEN 'bad time' WHEN 3 THEN 'too many columns' WHEN 4 THEN 'too few columns' "
        "ELSE 'accepted' END AS reason, count(*) AS cnt FROM events GROUP BY 1",
    ),
    "src3_multi_globs": (
        multi_globs,
        f"{q.with_(q.O_OBS)} SELECT CASE WHEN capture_time < {SPLITS['o']} THEN 'store' ELSE 'new' "
        "END AS src, data_source, count(*) AS cnt FROM o_obs GROUP BY ALL",
    ),
    "src3_store_only": (
        store_only,
        f"{q.with_(q.O_OBS)} SELECT 'store' AS src, data_source, count(*) AS cnt FROM o_obs GROUP BY ALL",
    ),
    "src1_mixed_headers": (
        mixed_headers,
        "SELECT CASE event_type WHEN 'click' THEN 'click' ELSE 'header differs' END AS data_source, "
        "count(*) AS cnt FROM events GROUP BY 1",
    ),
    "agg6_arrival_batches": (
        arrival_batches,
        f"{q.with_(_ARRIVALS, q.attrs('e'))}, {q.info_attr('e_attr', 'i')} SELECT entity_type, oid, "
        f"{_CODE} AS code, kind, value, last_time, last_arrival_time FROM i",
    ),
    "lkp3_delete_base_only": (
        delete_base_only,
        f"{_O}, {q.sides('o')}, {q.info('o_obs', 'i')}, b AS (SELECT entity_type, oid, "
        f"count(DISTINCT ({q.KEY}, code, value)) AS value_rows FROM o_attr WHERE oid NOT IN "
        "(SELECT oid FROM o_new_obs) GROUP BY ALL) SELECT entity_type, oid, cnt, days, value_rows "
        "FROM i LEFT JOIN b USING (entity_type, oid)",
    ),
    "snk14_retry": (
        load_retry,
        f"{_E}, {q.sides('e')}, fresh AS (SELECT DISTINCT {q.KEY} FROM (SELECT {q.KEY}, code, value "
        f"FROM e_new EXCEPT SELECT {q.KEY}, code, value FROM e_old)) SELECT md5(entity_type || {q.SEP} "
        f"|| oid || {q.SEP} || data_source || {q.SEP} || protocol || {q.SEP} || action) AS id, "
        "oid AS A010002, data_source AS B050016, protocol AS H010001, action AS H010003, "
        "string_agg(code || '=' || value, ';' ORDER BY code, value) AS props FROM (SELECT DISTINCT "
        f"{q.KEY}, code, value FROM e_attr SEMI JOIN fresh USING ({q.KEY})) GROUP BY {q.KEY}",
    ),
    "src4_snapshot_scan": (snapshot_scan, _E_BASE),
    "src5_queue_source": (
        queue_source,
        f"{q.with_(q.E_OBS)} SELECT {q.HEADER}, {_E_PROPS} AS props FROM e_obs",
    ),
    "src6_throttled_generation": (throttled_generation, _GENERATED),
    "src7_throttled_consumer": (
        throttled_consumer,
        f"{q.with_(q.E_OBS)} SELECT {_SHOWN} FROM e_obs",
    ),
    "gen1_observations": (generated, _GENERATED),
    "gen2_generation_job": (
        generation_job,
        f"{_generated_sql()} SELECT entity_type AS what, count(*) AS records FROM obs GROUP BY 1 "
        "UNION ALL SELECT 'summary', count(*) FROM orders",
    ),
    "lkp1_info_lookup": (
        info_lookup,
        f"{_E}, {q.info_attr('e_attr', 'a')}, {q.info('e_obs', 'i')} SELECT a.*, i.cnt, i.days "
        "FROM a JOIN i USING (entity_type, oid) WHERE oid = '8'",
    ),
    "lkp1_many": (
        many_lookups,
        f"{_O}, {q.info_attr('o_attr', 'a')}, {q.info('o_obs', 'i')}, k AS (SELECT DISTINCT oid FROM "
        "o_obs WHERE S1 = '1-URGENT' AND data_source = 'R') SELECT a.*, i.cnt, i.days "
        "FROM a JOIN i USING (entity_type, oid) WHERE oid IN (SELECT oid FROM k)",
    ),
    "joi1_info_merge": (
        info_merge,
        f"{_O}, {q.sides('o')}, {q.info('o_obs', 'i')}, "
        f"{q.status('o_old_obs', 'o_new_obs', 's', 'entity_type, oid')} SELECT entity_type, oid, cnt, "
        "first_time, last_time, day_cnt, days, status FROM i JOIN s USING (entity_type, oid)",
    ),
    "snk2_info_upsert": (
        info_upsert,
        f"{q.with_(q.O_OBS, q.info('o_obs', 'i'))} SELECT entity_type, oid, cnt, first_time, "
        "last_time, day_cnt, days FROM i",
    ),
    "lkp3_delete": (
        delete,
        f"{_O}, gone AS (SELECT DISTINCT oid FROM o_obs WHERE S1 = '1-URGENT' AND "
        "data_source = 'R'), b AS (SELECT entity_type, oid, "
        f"count(DISTINCT ({q.KEY}, code, value)) AS value_rows FROM o_attr GROUP BY ALL), "
        "i AS (SELECT entity_type, oid, count(*) AS cnt FROM o_obs GROUP BY ALL) "
        "SELECT entity_type, oid, value_rows, cnt FROM b JOIN i USING (entity_type, oid) "
        "WHERE oid NOT IN (SELECT oid FROM gone)",
    ),
    "lkp6_record_count": (record_count, "SELECT count(*) AS records FROM events"),
    "snk1_incremental_store": (
        incremental_store,
        f"{_O}, {q.sides('o')}, {q.base('o_old', 'b1')}, {q.base('o_attr', 'b2')} "
        f"SELECT data_source, code, {_SUMS}, CAST(1 AS BIGINT) AS version FROM b1 GROUP BY ALL "
        f"UNION ALL SELECT data_source, code, {_SUMS}, 2 FROM b2 GROUP BY ALL",
    ),
    "snk2_serving_upsert": (
        serving_upsert,
        f"{_O}, {q.base('o_attr', 'b')} SELECT {_BASE}, {q.SALT} || entity_type || {q.SEP} || oid "
        f"|| {q.SEP} || data_source || {q.SEP} || protocol || {q.SEP} || action AS row_key FROM b",
    ),
    "set2_status_folders": (
        status_folders,
        f"{_O}, {q.sides('o')}, {q.base('o_attr', 'b')}, {q.status('o_old', 'o_new', 's')} "
        f"SELECT status, {_SUMS} FROM b JOIN s USING ({q.KEY}) GROUP BY status",
    ),
    "snk3_keyed_load": (
        keyed_load,
        f"{q.with_(q.E_OBS)} SELECT {q.ENTITY_KEY} AS entity_key, data_source, count(*) AS "
        "records, 5 * count(*) AS attributes FROM e_obs GROUP BY ALL",
    ),
    "snk4_codecs": (
        codecs,
        f"{q.with_(q.E_OBS)}, c AS (SELECT unnest(['none', 'SnappyCodec', 'gzip', 'zstd', "
        "'unknown']) AS codec) SELECT codec, count(*) AS cnt, CAST(sum(capture_time) AS BIGINT) "
        "AS times FROM c CROSS JOIN e_obs GROUP BY codec",
    ),
    "snk7_rolled_files": (
        rolled_files, f"{q.with_(q.E_OBS)} SELECT {q.ENTITY_KEY} AS key, seq, M1 FROM e_obs"
    ),
    "snk8_rotation_by_size": (
        rotation_by_size,
        "SELECT count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS seqs, CAST(0 AS BIGINT) AS "
        "too_long FROM events",
    ),
    "snk9_dated_folders": (
        dated_folders,
        "SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS "
        "seqs FROM events GROUP BY 1",
    ),
    "snk10_delimited_sink": (
        delimited_sink, f"{q.with_(q.E_OBS)} SELECT seq || ',' || oid || ',' || M1 AS value FROM e_obs"
    ),
    "snk10_delimited_stream": (
        stream_text, f"{q.with_(q.E_OBS)} SELECT seq || ',' || oid || ',' || M1 AS value FROM e_obs"
    ),
    "snk11_post_close_move": (post_close_move, f"{q.with_(q.E_OBS)} SELECT seq, oid, M1 FROM e_obs"),
    "snk13_run_log": (
        run_log,
        f"{q.with_(q.O_OBS)} SELECT 'copy lines' AS job_name, 'rows' AS counter_group, 'written' AS "
        "counter_name, count(*) AS total FROM o_obs UNION ALL SELECT 'copy lines', 'rows', 'open', "
        "count(*) FILTER (action = 'O') FROM o_obs UNION ALL SELECT 'copy lines', 'rows', "
        "'key.urgent', count(*) FILTER (S1 = '1-URGENT') FROM o_obs UNION ALL "
        "SELECT 'copy lines', 'bytes', 'text', "
        "CAST(sum(length(M1)) AS BIGINT) FROM o_obs",
    ),
    "srt2_counter_order": (
        counter_order,
        f"{q.with_(q.O_OBS)}, c AS (SELECT 'seen' AS counter_group, 'in.' || action AS counter_name, "
        "count(*) AS total FROM o_obs GROUP BY 2 UNION ALL SELECT 'dated', action, "
        "max(capture_time) FROM o_obs GROUP BY 2) SELECT *, row_number() OVER "
        "(ORDER BY counter_group, counter_name) AS place FROM c",
    ),
    "snk12_printed_messages": (
        printed_messages,
        f"{q.with_(q.E_OBS)} SELECT {_SHOWN} FROM e_obs",
    ),
    "snk14_one_step_load": (
        one_step_load,
        f"{_E}, {q.sides('e')}, {q.info_attr('e_attr', 'i')}, {q.info_attr('e_old', 'j')}, "
        f"fresh AS (SELECT DISTINCT {q.KEY} FROM (SELECT {q.KEY}, code, value FROM e_new EXCEPT "
        f"SELECT {q.KEY}, code, value FROM e_old)), moved AS (SELECT DISTINCT entity_type, oid "
        "FROM (SELECT entity_type, oid, code, value FROM i EXCEPT SELECT entity_type, oid, code, "
        f"value FROM j)) SELECT {_CODE} AS code, count(*) AS cnt, CAST(sum(last_time) AS BIGINT) "
        "AS times FROM i GROUP BY 1 UNION ALL SELECT 'documents base', count(*), 0 FROM fresh "
        "UNION ALL SELECT 'documents info', count(*), 0 FROM moved",
    ),
    "str1_stream_base": (stream_base, _E_BASE),
    "str2_stream_info": (
        stream_info,
        f"{_E}, {q.info_attr('e_attr', 'i')} SELECT * FROM i",
    ),
    "str1_keyed_base": (keyed_base, _E_BASE),
    "str2_keyed_info": (
        keyed_info,
        f"{q.with_(q.E_OBS, q.info('e_obs', 'i'))} SELECT entity_type, oid, cnt, first_time, "
        "last_time, day_cnt, days FROM i",
    ),
    "str2_keyed_info_attributes": (
        keyed_info_attributes,
        f"{_E}, {q.info_attr('e_attr', 'i')} SELECT * FROM i",
    ),
    "str3_change_feed": (change_feed, _E_ATTRS),
    "str3_first_seen": (first_seen, _E_ATTRS),
    "str4_replay": (
        replay,
        f"{q.with_(q.E_OBS, q.info('e_obs', 'i'))} SELECT entity_type, oid, cnt, first_time, "
        "last_time, day_cnt, days FROM i",
    ),
    "str4_recovery": (
        recovery,
        f"{q.with_(q.E_OBS, q.info('e_obs', 'i'))} SELECT entity_type, oid, cnt, first_time, "
        "last_time, day_cnt, days, CAST(2 AS BIGINT) AS restarts FROM i",
    ),
    "joi2_stream_lookup": (
        stream_lookup,
        f"{_E}, arriving AS (SELECT {q.KEY}, seq % 3 AS batch_id, count(*) AS new_cnt FROM e_obs "
        f"GROUP BY ALL), held AS (SELECT {q.KEY}, b AS batch_id, count(DISTINCT (code, value)) AS "
        "stored_values, min(capture_time) AS stored_first_time, max(capture_time) AS "
        "stored_last_time FROM e_attr JOIN range(1, 3) r(b) ON seq % 3 < b GROUP BY ALL) "
        "SELECT arriving.*, stored_values, stored_first_time, stored_last_time, batch_id AS version "
        f"FROM arriving LEFT JOIN held USING ({q.KEY}, batch_id)",
    ),
    "lkp5_footer_counts": (footer_counts, _FOOTER_SQL),
    "str5_batch_folders": (
        batch_folders,
        "SELECT CAST(3 AS BIGINT) AS batches, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS "
        "seqs FROM events",
    ),
    "str6_late_data": (late_data, _E_BASE),
}
