"""Projections, joins with the dictionary, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary
from dossierlake.functions import keys, times, values
from dossierlake.operators import assemble, attributes, fold, merge
from dossierlake.plans.queries import oracle as q
from dossierlake.plans.queries.common import BUCKETS, SPLITS, flat
from dossierlake.sources import adapters
from dossierlake.sources.adapters import DICTIONARY, load_events, load_lines, table

PARTIAL = AttrDictionary(single=["S1"], multi=["M1"])
REPEATED = AttrDictionary(single=["S1", "S2"], multi=[])


def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.unpivot_attributes(load_lines(spark, sf_dir), DICTIONARY, distinct=False)
    return rows.drop("pos")


def multi_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_events(spark, sf_dir)
    return events.select("seq", "oid", F.explode(attributes.split_values(F.col("M1"))).alias("value"))


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = load_events(spark, sf_dir).withColumn("H010014", times.time_text(F.col("capture_time")))
    return text.select(
        "entity_type", "oid", times.parse_time(F.col("H010014")).alias("capture_time"),
        "data_source", "protocol", "action", "seq",
    )


def delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_lines(spark, sf_dir).withColumn("note", F.nullif(F.col("action"), F.lit("P")))
    return assemble.delimited(rows, ["seq", "oid", "note", "M1"], "|")


def kind_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.unpivot_attributes(load_lines(spark, sf_dir), DICTIONARY)
    return (
        attributes.with_fold_kind(rows, PARTIAL)
        .groupBy("code", "kind", "data_source")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def distinct_in_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = attributes.collect_props(load_events(spark, sf_dir), DICTIONARY)
    return attributes.explode_props(obs).select("seq", "oid", "code", "value")


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = attributes.collect_props(load_events(spark, sf_dir), DICTIONARY)
    last = obs.withColumn("props", attributes.last_single_props(F.col("props"), REPEATED))
    return attributes.explode_props(last, distinct=False).select("seq", "oid", "code", "value")


def display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.unpivot_attributes(load_events(spark, sf_dir), DICTIONARY)
    return flat(assemble.show_base(fold.base_profile(fold.fold_attr_day(rows))))


def dictionary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.unpivot_attributes(load_events(spark, sf_dir), DICTIONARY)
    return (
        PARTIAL.join_kind(rows)
        .groupBy("code", "kind", "protocol")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def union_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    return (
        merge.union_inputs(old, new)
        .groupBy("src", "data_source", "action")
        .agg(F.count(F.lit(1)).alias("cnt"), F.max("capture_time").alias("last_time"))
    )


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.lit("customer").alias("entity_type"), F.col("o_custkey").cast("string").alias("oid")
    ).distinct()


ENTITY_SQL = (
    "ent AS (SELECT DISTINCT 'customer' AS entity_type, CAST(o_custkey AS VARCHAR) AS oid "
    "FROM orders)"
)


def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _entities(spark, sf_dir)
    return e.select("*", keys.entity_key(F.col("entity_type"), F.col("oid")).alias("entity_key"))


def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_lines(spark, sf_dir).select(
        "entity_type", "oid", "data_source", "protocol", "action"
    ).distinct()
    return rows.select(
        keys.row_key(*[F.col(c) for c in rows.columns]).alias("base_row"),
        keys.row_key(F.col("entity_type"), F.col("oid")).alias("info_row"),
    )


def dimension_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = [F.col(c) for c in ("data_source", "protocol", "action")]
    return (
        load_events(spark, sf_dir)
        .groupBy(keys.dimension_id(*dims).alias("dim_id"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_lines(spark, sf_dir).select(
        "seq", times.day_number(F.col("capture_time")).cast("bigint").alias("day")
    )


def time_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = load_events(spark, sf_dir).select(
        "seq", times.time_text(F.col("capture_time")).alias("text")
    )
    return text.select("*", times.parse_time(F.col("text")).alias("seconds"))


def hex_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(values.to_hex(F.col("text"))).alias("hex_md5"))


def byte_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws(
            ",", *[F.pmod(F.col(c) * m, F.lit(256)).cast("string")
                   for c, m in (("event_id", 1), ("user_id", 7), ("event_id", 31))]
        ).alias("text"),
    )
    data = values.parse_byte_list(F.col("text"))
    return events.select(
        "event_id", values.to_hex(data).alias("hex"), values.format_byte_list(data).alias("text")
    )


def unsigned_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    digits = F.md5(F.col("o_orderkey").cast("string"))
    some = F.unhex(F.substring(digits, F.lit(1), ((F.col("o_orderkey") % 15 + 1) * 2).cast("int")))
    return orders.select("o_orderkey", values.unsigned_value(some).cast("string").alias("number"))


def random_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    seed = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        values.random_text(seed, 12).alias("alnum"),
        values.random_text(seed, 6, values.UPPER).alias("upper"),
    )


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        values.md5_hex(F.col("text")).alias("md5"),
        F.lower(F.hex(values.md5_raw(F.col("text")))).alias("raw"),
    )


def code_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.unpivot_attributes(load_events(spark, sf_dir), DICTIONARY)
    code = F.col("code")
    return rows.groupBy(
        "code",
        PARTIAL.is_kind(code, "single").cast("bigint").alias("is_single"),
        PARTIAL.is_kind(code, "multi").cast("bigint").alias("is_multi"),
    ).agg(F.count(F.lit(1)).alias("cnt"))


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_lines(spark, sf_dir).select(
        "entity_type", "oid", "data_source", "protocol", "action"
    ).distinct()
    cols = {c: F.col(c) for c in rows.columns}
    return rows.select(
        "oid", "data_source", "protocol", "action",
        keys.base_document_id(cols, compat=True).alias("compat_id"),
        keys.base_document_id(cols).alias("base_id"),
        keys.info_document_id(F.col("entity_type"), F.col("oid")).alias("info_id"),
    )


def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = _entities(spark, sf_dir)
    bucket = keys.bucket_of(F.col("entity_type"), F.col("oid"), BUCKETS).cast("bigint")
    salt = keys.salt_hex(F.col("entity_type"), F.col("oid"))
    first = F.element_at(
        F.array(*[F.lit(p) for p in ["0,0", *keys.split_points(BUCKETS)]]),
        F.col("bucket").cast("int") + 1,
    )
    return (
        entities.groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(salt).alias("low"), F.max(salt).alias("high"))
        .withColumn("start", first)
    )


def _random_sql(letters: str, length: int) -> str:
    draws = [
        f"substr('{letters}', CAST("
        + q.hex_number(f"substr(md5(o_orderkey || ':{i // 8}'), {4 * (i % 8) + 1}, 4)")
        + f" % {len(letters)} AS INTEGER) + 1, 1)"
        for i in range(length)
    ]
    return " || ".join(draws)


_E = q.fixture("e")
_O = q.fixture("o")
_DIMS = f"data_source || {q.SEP} || protocol || {q.SEP} || action"

QUERIES = {
    "prj1_unpivot": (
        unpivot, f"{q.fixture('o', True)} SELECT {q.HEADER}, code, value FROM o_attr"
    ),
    "prj2_multi_split": (
        multi_split,
        f"{q.with_(q.E_OBS)} SELECT seq, oid, unnest(string_split(M1, ',')) AS value FROM e_obs",
    ),
    "prj3_header": (header, f"{q.with_(q.E_OBS)} SELECT {q.HEADER} FROM e_obs"),
    "prj4_delimited": (
        delimited,
        f"{q.with_(q.O_OBS)} SELECT seq || '|' || oid || '|' || "
        "coalesce(nullif(action, 'P'), 'null') || '|' || M1 AS value FROM o_obs",
    ),
    "prj5_kind_partition": (
        kind_partition,
        f"{_O} SELECT code, CASE WHEN code = 'M1' THEN 'multi' ELSE 'single' END AS kind, "
        "data_source, count(*) AS cnt FROM o_attr GROUP BY ALL",
    ),
    "prj6_distinct_in_record": (distinct_in_record, f"{_E} SELECT seq, oid, code, value FROM e_attr"),
    "prj7_last_wins": (
        last_wins,
        f"{q.with_(q.E_OBS)} SELECT seq, oid, 'S1' AS code, S1 AS value FROM e_obs "
        "UNION ALL SELECT seq, oid, 'S2', S2 FROM e_obs "
        "UNION ALL SELECT seq, oid, 'M1', string_split(M1, ',')[-1] FROM e_obs",
    ),
    "prj8_display": (
        display,
        f"{_E}, {q.base('e_attr', 'b')} SELECT {q.KEY}, code, value, cnt, day_cnt, "
        f"{q.time_text('first_time')} AS first_time, {q.time_text('last_time')} AS last_time, "
        "days AS day_stats FROM b",
    ),
    "joi3_dictionary_join": (
        dictionary_join,
        f"{_E} SELECT code, CASE code WHEN 'M1' THEN 'multi' WHEN 'S1' THEN 'single' END AS kind, "
        "protocol, count(*) AS cnt FROM e_attr GROUP BY ALL",
    ),
    "set1_union": (
        union_inputs,
        f"{q.with_(q.O_OBS)} SELECT CASE WHEN capture_time < {SPLITS['o']} THEN 'store' "
        "ELSE 'new' END AS src, data_source, action, count(*) AS cnt, "
        "max(capture_time) AS last_time FROM o_obs GROUP BY ALL",
    ),
    "fn1_entity_key": (
        entity_keys, f"WITH {ENTITY_SQL} SELECT *, {q.ENTITY_KEY} AS entity_key FROM ent"
    ),
    "fn2_row_key": (
        row_keys,
        f"{q.with_(q.O_OBS)} SELECT DISTINCT {q.SALT} || entity_type || {q.SEP} || oid || "
        f"{q.SEP} || {_DIMS} AS base_row, {q.SALT} || entity_type || {q.SEP} || oid AS info_row "
        "FROM o_obs",
    ),
    "fn3_dimension_id": (
        dimension_ids,
        f"{q.with_(q.E_OBS)} SELECT {_DIMS} AS dim_id, count(*) AS cnt FROM e_obs GROUP BY ALL",
    ),
    "fn4_day_number": (day_numbers, f"{q.with_(q.O_OBS)} SELECT seq, {q.day()} AS day FROM o_obs"),
    "fn5_time_text": (
        time_round_trip,
        f"{q.with_(q.E_OBS)} SELECT seq, {q.time_text('capture_time')} AS text, "
        "capture_time AS seconds FROM e_obs",
    ),
    "fn6_hex": (hex_text, "SELECT doc_id, md5(lower(hex(text))) AS hex_md5 FROM documents"),
    "fn7_byte_list": (
        byte_lists,
        "WITH b AS (SELECT event_id, event_id % 256 AS b1, (user_id * 7) % 256 AS b2, "
        "(event_id * 31) % 256 AS b3 FROM events) SELECT event_id, "
        "printf('%02x%02x%02x', b1, b2, b3) AS hex, b1 || ',' || b2 || ',' || b3 AS text FROM b",
    ),
    "fn8_unsigned": (
        unsigned_values,
        "SELECT o_orderkey, CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, "
        "2 * (o_orderkey % 15 + 1)) AS HUGEINT) AS VARCHAR) AS number FROM orders",
    ),
    "fn9_random_text": (
        random_texts,
        f"SELECT o_orderkey, {_random_sql(values.ALNUM, 12)} AS alnum, "
        f"{_random_sql(values.UPPER, 6)} AS upper FROM orders",
    ),
    "fn10_md5": (digests, "SELECT doc_id, md5(text) AS md5, md5(text) AS raw FROM documents"),
    "fn11_code_kind": (
        code_kinds,
        f"{_E} SELECT code, CAST(code = 'S1' AS BIGINT) AS is_single, "
        "CAST(code = 'M1' AS BIGINT) AS is_multi, count(*) AS cnt FROM e_attr GROUP BY ALL",
    ),
    "fn12_document_id": (
        document_ids,
        f"{q.with_(q.O_OBS)} SELECT DISTINCT oid, data_source, protocol, action, "
        f"md5(entity_type || {q.SEP} || oid || {q.SEP} || data_source) AS compat_id, "
        f"md5(entity_type || {q.SEP} || oid || {q.SEP} || {_DIMS}) AS base_id, "
        f"{q.ENTITY_KEY} AS info_id FROM o_obs",
    ),
    "fn13_split_points": (
        split_points,
        f"WITH {ENTITY_SQL} SELECT {q.bucket(BUCKETS)} AS bucket, count(*) AS cnt, "
        f"min({q.SALT}) AS low, max({q.SALT}) AS high, "
        f"CAST(CAST({q.bucket(BUCKETS)} * {256 // BUCKETS} AS BIGINT) AS VARCHAR) || ',0' AS start "
        "FROM ent GROUP BY 1, 5",
    ),
}
