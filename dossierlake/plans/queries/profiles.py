"""Folds, merges and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.dictionary import MULTI
from dossierlake.functions.keys import entity_key
from dossierlake.operators import accumulate, assemble, documents, fold, lookup, merge
from dossierlake.operators.attributes import SLOT, dealt_by_day
from dossierlake.operators.parts import PAGE_ITEMS, dealing
from dossierlake.operators.placing import placing
from dossierlake.plans.colocated import BucketedProfiles, buckets_for
from dossierlake.plans.profiles import attribute_rows, day_tables, merged_with_status
from dossierlake.plans.queries import oracle as q
from dossierlake.plans.queries.common import BUCKETS, SPLITS, attr_sides, flat, sides
from dossierlake.plans.search_index import SearchIndex, Term
from dossierlake.schema import ATTR_KEY, ENTITY, ROW_KEY
from dossierlake.session import materialize, work_dir
from dossierlake.sources import adapters
from dossierlake.sources.adapters import DICTIONARY, load_events, load_lines, table

# The index time that documents carry in the checks.
AS_OF = 1_700_000_000
# Pages of the paged variants.
PAGES = 3
# Items of a page in the ranked variants.
LENGTH = 4


def base_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.base_counters(attribute_rows(load_lines(spark, sf_dir), DICTIONARY))


def base_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_events(spark, sf_dir), DICTIONARY)
    return flat(fold.base_profile(fold.fold_attr_day(rows)))


def _placed_bases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame | None]:
    """Base profiles of all order lines: where their entities lie, with the slot, and of busy entities."""
    lines = placing(load_lines(spark, sf_dir))
    days = fold.fold_attr_day(attribute_rows(lines.calm(), DICTIONARY))
    calm, busy = fold.base_profile(days, placed=True, also=(SLOT,)), lines.busy_ones()
    if busy is None:
        return calm, None
    rows = attribute_rows(dealt_by_day(busy, lines.slots), DICTIONARY)
    return calm, fold.base_profile(fold.fold_attr_day(rows))


def base_fold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    calm, busy = _placed_bases(spark, sf_dir)
    base = calm.drop(SLOT)
    return flat(base if busy is None else base.unionByName(busy))


def base_fold_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_events(spark, sf_dir), DICTIONARY, count_repeats=True)
    return flat(fold.base_profile(fold.fold_attr_day(rows)))


def merge_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of each event type, folded apart and merged."""
    events = load_events(spark, sf_dir)
    kinds = [F.col("seq") % 3 == i for i in range(3)]
    parts = [fold.fold_attr_day(attribute_rows(events.where(k), DICTIONARY)) for k in kinds]
    return flat(fold.base_profile(fold.merge_attr_day(*parts)))


def info_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fold.info_profile(fold.fold_entity_day(load_lines(spark, sf_dir))))


def _info_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_lines(spark, sf_dir), DICTIONARY)
    return fold.info_attributes(fold.fold_attr_day(rows), DICTIONARY)


def latest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = _info_attr(spark, sf_dir).where(F.col("kind") != MULTI)
    return info.select(*ENTITY, "code", "value", "last_time")


def multi_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = _info_attr(spark, sf_dir).where(F.col("kind") == MULTI)
    return info.select(*ENTITY, "code", "value", "last_time", "last_arrival_time")


def latest_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_lines(spark, sf_dir).drop("M1"), DICTIONARY)
    return fold.latest_by_window(rows)


def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    return merge.classify(old, new)


def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = sides(spark, sf_dir, "o")
    return merge.merge_counters(old, new)


def accumulators(
    spark: SparkSession, sf_dir: str, pages: int | None = None, length: int = PAGE_ITEMS
) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    pairs = [
        (F.concat(F.lit("l:"), "event_type"), k),
        (F.concat(F.lit("f:"), "event_type"), F.col("value").cast("string")),
        (F.concat(F.lit("s:"), "event_type", F.lit(":"), F.col("user_id").cast("string")), k),
        (F.concat(F.lit("x:"), "event_type"), k),
    ]
    fields = events.select(
        F.explode(
            F.array(*[F.struct(f.alias("field"), v.alias("value")) for f, v in pairs])
        ).alias("p")
    ).select("p.*")
    cents = F.round(F.col("value").try_cast("double") * 100).cast("bigint").cast("string")
    return accumulate.accumulate(fields, pages, length).select(
        "field",
        F.col("page").cast("bigint").alias("page"),
        F.when(F.col("field").startswith("f:"), cents).otherwise(F.col("value")).alias("value"),
    )


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of a customer stand for the records of a task."""
    orders = table(spark, sf_dir, "orders")
    tasks = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("o_orderkey") * 1000).alias("bytes"),
        F.sum(F.col("o_orderkey") % 1000 + 1).alias("millis"),
    )
    summary = accumulate.throughput(tasks)
    return summary.select(
        *[
            F.round(c, 4).alias(c) if t == "double" else F.col(c)
            for c, t in summary.dtypes
        ]
    )


def grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = load_lines(spark, sf_dir)
    return obs.groupBy(entity_key(F.col("entity_type"), F.col("oid")).alias("entity_key")).agg(
        F.count(F.lit(1)).alias("records"), F.min("seq").alias("first_seq")
    )


def nested(
    spark: SparkSession, sf_dir: str, pages: int | None = None, length: int = PAGE_ITEMS
) -> DataFrame:
    calm, busy = _placed_bases(spark, sf_dir)
    nest = assemble.nest_base(calm, pages, length, placed=True).drop(SLOT)
    if busy is not None:
        nest = nest.unionByName(assemble.nest_base(materialize(busy, "base"), pages, length))
    text = F.transform(
        "props",
        lambda p: F.concat_ws(
            "|", p["code"], p["value"], p["cnt"].cast("string"), p["day_cnt"].cast("string")
        ),
    )
    return nest.select(
        *ROW_KEY,
        F.col("page").cast("bigint").alias("page"),
        F.size("props").cast("bigint").alias("n"),
        F.array_join(text, ";").alias("props"),
    )


def sorted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fold.info_profile(fold.fold_entity_day(load_events(spark, sf_dir)))
    return days.select("oid", fold.days_text(F.col("days")).alias("days"))


def key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_lines(spark, sf_dir).select(*ROW_KEY).distinct()
    return lookup.key_ordered(rows)


def cogroup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = attr_sides(spark, sf_dir, "o")
    return flat(merged_with_status(old, new))


def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on bucketed tables, where the stored side does not move."""
    old, new = attr_sides(spark, sf_dir, "o")
    buckets = buckets_for(old.count() + new.count(), BUCKETS)
    store = BucketedProfiles(spark, work_dir(spark, "bucketed"), buckets, PAGES).build(fold.base_profile(old))
    merged = store.merge(fold.base_profile(new), work_dir(spark, "bucketed"))
    return flat(merged.read("base").drop("page"))


def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    return merge.stored_lookup(new, fold.base_counters(attribute_rows(old, DICTIONARY)))


def new_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])
    return merge.new_values(attribute_rows(old, DICTIONARY), attribute_rows(new, DICTIONARY))


def changed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = attr_sides(spark, sf_dir, "o")
    by = dealing(old.unionByName(new), ROW_KEY)
    calm, busy = by.split(old.unionByName(new))
    merged = [fold.base_profile(fold.merge_attr_day(calm), placed=True)]
    if busy is not None:
        merged.append(fold.base_profile(fold.merge_attr_day(busy, by=ATTR_KEY), placed=True))
    # A row key is split as a whole, so its values are summed where they lie and written once for both parts.
    sums = [
        rows.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("value_rows"), F.sum("cnt").alias("cnt"))
        for rows in merged
    ]
    sums = materialize(reduce(DataFrame.unionByName, sums), "row-sums")
    parts = [
        split(sums, new)
        .groupBy("data_source")
        .agg(F.sum("value_rows").alias("value_rows"), F.sum("cnt").alias("cnt"))
        .withColumn("part", F.lit(name))
        for name, split in (("changed", merge.changed_part), ("unchanged", merge.unchanged_part))
    ]
    return parts[0].unionByName(parts[1])


def base_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_events(spark, sf_dir), DICTIONARY)
    base = fold.base_counters(rows)
    return lookup.find_base(base, "user", "8", ["click", "l"], prefix_last=True)


def slice_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.slice_rows(load_events(spark, sf_dir), ["seq"], 101, 50)


def far_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.slice_by_ranges(load_events(spark, sf_dir), ["seq"], 701, 150)


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = day_tables(load_lines(spark, sf_dir), DICTIONARY)
    return flat(
        lookup.count_by_bucket(
            {
                "base": tables["attr_day"].select(*ROW_KEY).distinct(),
                "info": tables["entity_day"].select(*ENTITY).distinct(),
            },
            16,
        )
    )


def attribute_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attribute_rows(load_lines(spark, sf_dir), DICTIONARY)
    pair = [lookup.has("S1", "1-URGENT", protocol="O"), lookup.has("M1", "s3", "F", "F")]
    every = lookup.search(rows, pair, "and").withColumn("mode", F.lit("and"))
    either = lookup.search(
        rows, [lookup.has("M1", "q4"), lookup.has("S2", "RF")], "or"
    ).withColumn("mode", F.lit("or"))
    return every.unionByName(either)


def _indexed(spark: SparkSession, sf_dir: str) -> SearchIndex:
    index = SearchIndex(spark, work_dir(spark, "search-index"))
    for name, half in zip(("old", "new"), adapters.split_stored(load_lines(spark, sf_dir), SPLITS["o"])):
        index.add(attribute_rows(half, DICTIONARY), name)
    return index


PAIR = [Term("S1", "1-URGENT", protocol="O"), Term("M1", "s3", "F", "F")]
EITHER = [Term("M1", "q4"), Term("S2", "RF")]


def index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search on bitmaps of two batches."""
    index = _indexed(spark, sf_dir)
    every = index.search(PAIR, "and").withColumn("mode", F.lit("and"))
    return every.unionByName(index.search(EITHER, "or").withColumn("mode", F.lit("or")))


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _indexed(spark, sf_dir)
    every = index.count(PAIR, "and").withColumn("mode", F.lit("and"))
    return every.unionByName(index.count(EITHER, "or").withColumn("mode", F.lit("or")))


def _base_docs(
    spark: SparkSession, sf_dir: str, compat: bool, pages: int | None = None, length: int = PAGE_ITEMS
) -> DataFrame:
    tables = attr_sides(spark, sf_dir, "o")
    both = tables[0].unionByName(tables[1])
    by = dealing(both, ROW_KEY)
    docs = documents.base_documents(
        both,
        F.lit(AS_OF),
        documents.base_rows_to_index(*tables, by),
        compat_ids=compat,
        pages=pages,
        length=length,
        by=by,
    )
    text = F.transform(
        "props", lambda p: F.concat(F.map_keys(p)[0], F.lit("="), F.map_values(p)[0])
    )
    return flat(docs.withColumn("props", F.array_join(text, ";")))


def base_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_docs(spark, sf_dir, compat=False)


def base_documents_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_docs(spark, sf_dir, compat=True)


def _info_docs(
    spark: SparkSession, sf_dir: str, compat: bool, pages: int | None = None, length: int = PAGE_ITEMS
) -> DataFrame:
    tables = attr_sides(spark, sf_dir, "o")
    entities = documents.info_entities_to_index(*tables, DICTIONARY, compat_trigger=compat)
    info = fold.info_attributes(tables[0].unionByName(tables[1]), DICTIONARY)
    docs = documents.info_documents(info, F.lit(AS_OF), entities, pages, length)
    return docs.select(
        "id", F.col("page").cast("bigint").alias("page"),
        documents.FIELD_TIME, documents.FIELD_TYPE, documents.FIELD_OID,
        F.try_element_at("single", F.lit("S1")).alias("S1"),
        F.try_element_at("single", F.lit("S2")).alias("S2"),
        F.array_join(F.try_element_at("multi", F.lit("M1")), ",").alias("M1"),
    )


def info_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _info_docs(spark, sf_dir, compat=False)


def info_documents_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _info_docs(spark, sf_dir, compat=True)


def accumulators_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulators(spark, sf_dir, PAGES)


def nested_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested(spark, sf_dir, PAGES)


def base_documents_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_docs(spark, sf_dir, compat=False, pages=PAGES)


def info_documents_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _info_docs(spark, sf_dir, compat=False, pages=PAGES)


def accumulators_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulators(spark, sf_dir, length=LENGTH)


def nested_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested(spark, sf_dir, length=LENGTH)


def base_documents_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base_docs(spark, sf_dir, compat=False, length=LENGTH)


def info_documents_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _info_docs(spark, sf_dir, compat=False, length=LENGTH)


_E = q.fixture("e")
_O = q.fixture("o")
_BASE = f"{q.KEY}, code, value, cnt, first_time, last_time, day_cnt, days"
_E_BASE = f"{_E}, {q.base('e_attr', 'b')} SELECT {_BASE} FROM b"
_O_INFO = f"{_O}, {q.info_attr('o_attr', 'i')}"
_RATES = [("mb", "bytes", "1048576.0"), ("rec", "records", "1.0")]


def _throughput_sql() -> str:
    parts = ["count(*) AS tasks", "round(sum(bytes) / 1048576.0, 4) AS total_mb",
             "CAST(sum(records) AS BIGINT) AS total_records"]
    for name, size, unit in _RATES:
        rate = f"{size} * 1000.0 / (millis * {unit})"
        parts += [
            f"round(sum({size}) * 1000.0 / (sum(millis) * {unit}), 4) AS {name}_throughput",
            f"round(avg({rate}), 4) AS {name}_rate_mean",
            f"round(stddev_pop({rate}), 4) AS {name}_rate_std",
            f"round(sum({size}) * 1000.0 / (max(millis) * {unit}), 4) AS {name}_cluster_rate",
        ]
    return (
        "WITH t AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS records, "
        "CAST(sum(o_orderkey * 1000) AS DOUBLE) AS bytes, "
        "CAST(sum(o_orderkey % 1000 + 1) AS DOUBLE) AS millis FROM orders GROUP BY 1) "
        f"SELECT {', '.join(parts)} FROM t"
    )


def _rank_page(length: int, key: str, order: str) -> str:
    rank = f"row_number() OVER (PARTITION BY {key} ORDER BY {order})"
    return f"CAST(({rank} - 1) // {length} AS BIGINT)"


def _page(pages: int, *items: str) -> str:
    digest = f"md5({f' || {q.SEP} || '.join(items)})"
    return f"{q.hex_number(f'substr({digest}, 1, 8)')} % {pages}"


def _paged_id(sql: str, pages: int | None) -> str:
    if pages == 1:
        return sql
    ended = f"{sql} || '-' || page"
    return ended if pages else f"CASE WHEN page = 0 THEN {sql} ELSE {ended} END"


def _counter_sql() -> str:
    """Status counts, and the bytes of day-table rows read, written and left alone.

    A row counts the bytes of its texts and eight for each of its numbers.
    """
    ctes, rows = [], []
    texts = {name: f"strlen({name})" for name in [*q.KEY.split(", "), "code", "value"]}
    for label, kind, key, numbers in (
        ("BASE", "", [*q.KEY.split(", "), "code", "value"], 6),
        ("INFO", "_obs", ["entity_type", "oid"], 4),
    ):
        columns, group = ", ".join(key), q.KEY if label == "BASE" else "entity_type, oid"
        size = " + ".join([texts[k] for k in key]) + f" + {8 * numbers}"
        name = label.lower()
        for side in ("old", "new"):
            ctes.append(
                f"{name}_{side} AS (SELECT {group}, CAST(sum({size}) AS BIGINT) AS bytes FROM "
                f"(SELECT DISTINCT {columns}, {q.day()} AS day FROM o_{side}{kind}) GROUP BY {group})"
            )
        ctes.append(
            f"{name}_keys AS (SELECT o.bytes AS old_bytes, n.bytes AS new_bytes FROM {name}_old o "
            f"FULL JOIN {name}_new n USING ({group}))"
        )
        old, new = "old_bytes IS NOT NULL", "new_bytes IS NOT NULL"
        for counter, value in {
            "NUM_NEW": f"count(*) FILTER (NOT ({old}))",
            "NUM_UPDATE": f"count(*) FILTER ({old} AND {new})",
            "NUM_UNCHANGED": f"count(*) FILTER (NOT ({new}))",
            "BYTES_READ": f"sum(old_bytes) FILTER ({new})",
            "BYTES_WRITE": "sum(new_bytes)",
            "BYTES_UNCHANGED": f"sum(old_bytes) FILTER (NOT ({new}))",
        }.items():
            rows.append(
                f"SELECT '{label}_{counter}' AS counter, CAST(coalesce({value}, 0) AS BIGINT) AS total "
                f"FROM {name}_keys"
            )
    return f"{_O}, {q.sides('o')}, {', '.join(ctes)} {' UNION ALL '.join(rows)}"


_DOC_FIELDS = (
    f"CAST({AS_OF} AS BIGINT) AS H010014, entity_type AS A010001, oid AS A010002, "
    "data_source AS B050016, protocol AS H010001, action AS H010003"
)
_NEW_ROWS = (
    f"fresh AS (SELECT DISTINCT {q.KEY} FROM (SELECT {q.KEY}, code, value FROM o_new "
    f"EXCEPT SELECT {q.KEY}, code, value FROM o_old))"
)
_PROPS = "string_agg(code || '=' || value, ';' ORDER BY code, value) AS props"
_ROW_ID = f"entity_type || {q.SEP} || oid || {q.SEP} || data_source"


def _base_doc_sql(pages: int | None, length: int = PAGE_ITEMS) -> str:
    page = _page(pages, "code", "value") if pages else _rank_page(length, q.KEY, "code, value")
    row_id = f"md5({_ROW_ID} || {q.SEP} || protocol || {q.SEP} || action)"
    return (
        f"{_O}, {q.sides('o')}, {_NEW_ROWS} SELECT {_paged_id(row_id, pages)} AS id, page, "
        f"{_DOC_FIELDS}, {_PROPS} FROM (SELECT *, {page} AS page FROM (SELECT DISTINCT {q.KEY}, "
        f"code, value FROM o_attr SEMI JOIN fresh USING ({q.KEY}))) "
        f"GROUP BY {q.KEY}, page"
    )


def _accumulator_sql(pages: int | None, length: int = PAGE_ITEMS) -> str:
    # A text begins after all smaller ones; after every full page of its repeats it begins anew.
    group = "PARTITION BY event_type, user_id"
    place = (
        f"count(*) OVER ({group} ORDER BY k) - count(*) OVER ({group}, k) + "
        f"(row_number() OVER ({group}, k) - 1) // {length} * {length}"
    )
    page = _page(pages, "k") if pages else f"CAST(({place}) // {length} AS BIGINT)"
    return (
        "WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events), "
        f"t AS (SELECT *, {page} AS p FROM e) "
        "SELECT 'l:' || event_type AS field, CAST(0 AS BIGINT) AS page, "
        "CAST(sum(CAST(k AS BIGINT)) AS VARCHAR) AS value FROM e GROUP BY event_type UNION ALL "
        "SELECT 'f:' || event_type, 0, CAST(CAST(round(sum(value) * 100) AS BIGINT) AS VARCHAR) "
        "FROM e GROUP BY event_type UNION ALL "
        "SELECT 's:' || event_type || ':' || user_id, p, "
        "string_agg(k || ';', '' ORDER BY k) FROM t GROUP BY event_type, user_id, p"
    )


def _nested_sql(pages: int | None, length: int = PAGE_ITEMS) -> str:
    page = _page(pages, "code", "value") if pages else _rank_page(length, q.KEY, "code, value")
    return (
        f"{_O}, {q.base('o_attr', 'b')}, b_ AS (SELECT *, {page} AS page FROM b) SELECT {q.KEY}, page, "
        "count(*) AS n, string_agg(code || '|' || value || '|' || cnt || '|' || day_cnt, ';' "
        f"ORDER BY code, value) AS props FROM b_ GROUP BY {q.KEY}, page"
    )


_INFO_CHANGED = (
    "SELECT entity_type, oid FROM (SELECT entity_type, oid, code, value FROM after "
    "EXCEPT SELECT entity_type, oid, code, value FROM before)"
)


def _info_doc_sql(changed: str, pages: int | None = None, length: int = PAGE_ITEMS) -> str:
    page = _page(pages, "code", "value") if pages else _rank_page(length, "entity_type, oid", "code, value")
    return (
        f"{_O}, {q.sides('o')}, {q.info_attr('o_attr', 'after')}, "
        f"{q.info_attr('o_old', 'before')}, changed AS ({changed}) "
        f"SELECT {_paged_id(q.ENTITY_KEY, pages)} AS id, page, "
        f"CAST({AS_OF} AS BIGINT) AS H010014, "
        "entity_type AS A010001, oid AS A010002, max(CASE WHEN code = 'S1' THEN value END) AS S1, "
        "max(CASE WHEN code = 'S2' THEN value END) AS S2, "
        "string_agg(CASE WHEN code = 'M1' THEN value END, ',' ORDER BY value) AS M1 "
        f"FROM (SELECT *, {page} AS page FROM after SEMI JOIN changed USING (entity_type, oid)) "
        "GROUP BY entity_type, oid, page"
    )


_SEARCH = (
    f"{_O} SELECT entity_type, oid, 'and' AS mode FROM (SELECT DISTINCT entity_type, oid FROM "
    "o_attr WHERE code = 'S1' AND value = '1-URGENT' AND protocol = 'O' INTERSECT "
    "SELECT entity_type, oid FROM o_attr WHERE code = 'M1' AND value = 's3' AND "
    "protocol = 'F' AND action = 'F') UNION ALL "
    "SELECT DISTINCT entity_type, oid, 'or' FROM o_attr WHERE (code = 'M1' AND value = 'q4') "
    "OR (code = 'S2' AND value = 'RF')"
)

QUERIES = {
    "agg1_base_counters": (
        base_counters,
        f"{_O} SELECT {q.KEY}, code, value, count(*) AS cnt, min(capture_time) AS first_time, "
        f"max(capture_time) AS last_time FROM o_attr GROUP BY {q.KEY}, code, value",
    ),
    "agg1_base_fold": (base_fold, _E_BASE),
    "agg2_day_histogram": (
        base_fold_lines, f"{_O}, {q.base('o_attr', 'b')} SELECT {_BASE} FROM b"
    ),
    "agg2_count_repeats": (
        base_fold_repeats,
        f"{q.fixture('e', True)}, {q.base('e_attr', 'b')} SELECT {_BASE} FROM b",
    ),
    "agg3_merge_partials": (merge_partials, _E_BASE),
    "agg4_info_fold": (
        info_fold,
        f"{q.with_(q.O_OBS, q.info('o_obs', 'i'))} SELECT entity_type, oid, cnt, first_time, "
        "last_time, day_cnt, days FROM i",
    ),
    "agg5_latest_single": (
        latest_single,
        f"{_O_INFO} SELECT entity_type, oid, code, value, last_time FROM i WHERE kind = 'single'",
    ),
    "agg6_multi_values": (
        multi_values,
        f"{_O_INFO} SELECT entity_type, oid, code, value, last_time, last_arrival_time FROM i "
        "WHERE kind = 'multi'",
    ),
    "agg7_classify": (
        classify, f"{_O}, {q.sides('o')}, {q.status('o_old', 'o_new', 's')} SELECT * FROM s"
    ),
    "agg8_merge_counters": (merge_counters, _counter_sql()),
    "agg9_accumulators": (accumulators, _accumulator_sql(None)),
    "agg9_accumulators_ranked": (accumulators_ranked, _accumulator_sql(None, LENGTH)),
    "agg9_accumulators_paged": (accumulators_paged, _accumulator_sql(PAGES)),
    "agg10_throughput": (throughput, _throughput_sql()),
    "agg11_object_grouping": (
        grouping,
        f"{q.with_(q.O_OBS)} SELECT {q.ENTITY_KEY} AS entity_key, count(*) AS records, "
        "min(seq) AS first_seq FROM o_obs GROUP BY 1",
    ),
    "agg12_nested_profile": (nested, _nested_sql(None)),
    "agg12_nested_profile_ranked": (nested_ranked, _nested_sql(None, LENGTH)),
    "agg12_nested_profile_paged": (nested_paged, _nested_sql(PAGES)),
    "win1_latest_by_window": (
        latest_by_window,
        f"{_O_INFO} SELECT entity_type, oid, code, value, last_time FROM i WHERE kind = 'single'",
    ),
    "srt1_sorted_days": (
        sorted_days, f"{q.with_(q.E_OBS, q.info('e_obs', 'i'))} SELECT oid, days FROM i"
    ),
    "srt3_key_order": (
        key_order,
        f"{q.with_(q.O_OBS)} SELECT DISTINCT {q.KEY}, {q.SALT} AS salt FROM o_obs "
        f"ORDER BY salt, {q.KEY}",
    ),
    "joi1_cogroup_merge": (
        cogroup_merge,
        f"{_O}, {q.sides('o')}, {q.base('o_attr', 'b')}, {q.status('o_old', 'o_new', 's')} "
        f"SELECT {_BASE}, status FROM b JOIN s USING ({q.KEY})",
    ),
    "joi1_bucketed_merge": (
        bucketed_merge,
        f"{_O}, {q.sides('o')}, {q.base('o_attr', 'b')}, {q.status('o_old', 'o_new', 's')} "
        f"SELECT {_BASE}, status FROM b JOIN s USING ({q.KEY})",
    ),
    "joi2_stored_lookup": (
        stored_lookup,
        f"{_O}, {q.sides('o')}, held AS (SELECT {q.KEY}, count(DISTINCT (code, value)) AS "
        "stored_values, min(capture_time) AS stored_first_time, max(capture_time) AS "
        f"stored_last_time FROM o_old GROUP BY {q.KEY}), arriving AS (SELECT {q.KEY}, count(*) AS "
        f"new_cnt FROM o_new_obs GROUP BY {q.KEY}) SELECT * FROM arriving LEFT JOIN held "
        f"USING ({q.KEY})",
    ),
    "joi4_new_values": (
        new_values,
        f"{_O}, {q.sides('o')} SELECT {q.KEY}, code, value FROM o_new "
        f"EXCEPT SELECT {q.KEY}, code, value FROM o_old",
    ),
    "set2_changed_split": (
        changed_split,
        f"{_O}, {q.sides('o')}, {q.base('o_attr', 'b')}, {q.status('o_old', 'o_new', 's')} "
        "SELECT data_source, count(*) AS value_rows, CAST(sum(cnt) AS BIGINT) AS cnt, "
        "CASE status WHEN 'UNCHANGED' THEN 'unchanged' ELSE 'changed' END AS part "
        f"FROM b JOIN s USING ({q.KEY}) GROUP BY data_source, 4",
    ),
    "lkp2_base_lookup": (
        base_lookup,
        f"{_E} SELECT {q.KEY}, code, value, count(*) AS cnt, min(capture_time) AS first_time, "
        "max(capture_time) AS last_time FROM e_attr WHERE oid = '8' AND data_source = 'click' "
        f"AND protocol LIKE 'l%' GROUP BY {q.KEY}, code, value",
    ),
    "lkp4_slice": (
        slice_preview,
        f"{q.with_(q.E_OBS)} SELECT {q.HEADER}, S1, S2, M1 FROM e_obs "
        "ORDER BY seq LIMIT 50 OFFSET 100",
    ),
    "lkp4_far_slice": (
        far_slice,
        f"{q.with_(q.E_OBS)} SELECT {q.HEADER}, S1, S2, M1 FROM e_obs "
        "ORDER BY seq LIMIT 150 OFFSET 700",
    ),
    "lkp5_bucket_counts": (
        bucket_counts,
        f"{q.with_(q.O_OBS)}, r AS (SELECT 'base' AS \"table\", {q.bucket(16)} AS bucket FROM "
        f"(SELECT DISTINCT {q.KEY} FROM o_obs) UNION ALL SELECT 'info', {q.bucket(16)} FROM "
        "(SELECT DISTINCT entity_type, oid FROM o_obs)) "
        "SELECT \"table\", bucket, count(*) AS cnt FROM r GROUP BY ROLLUP (\"table\", bucket)",
    ),
    "lkp7_attribute_search": (attribute_search, _SEARCH),
    "lkp7_index_search": (index_search, _SEARCH),
    "lkp7_index_counts": (
        index_counts, f"SELECT mode, count(*) AS entities FROM ({_SEARCH}) GROUP BY mode"
    ),
    "snk5_base_documents": (base_documents, _base_doc_sql(None)),
    "snk5_base_documents_ranked": (base_documents_ranked, _base_doc_sql(None, LENGTH)),
    "snk5_base_documents_paged": (base_documents_paged, _base_doc_sql(PAGES)),
    "snk5_base_documents_compat": (
        base_documents_compat,
        f"{_O}, {q.sides('o')}, {_NEW_ROWS}, cand AS (SELECT {q.KEY}, max(capture_time) AS t "
        f"FROM o_attr SEMI JOIN fresh USING ({q.KEY}) GROUP BY {q.KEY}), last AS (SELECT * FROM "
        "cand QUALIFY row_number() OVER (PARTITION BY entity_type, oid, data_source "
        "ORDER BY t DESC, protocol DESC, action DESC) = 1) "
        f"SELECT md5({_ROW_ID}) AS id, CAST(0 AS BIGINT) AS page, {_DOC_FIELDS}, {_PROPS} FROM (SELECT DISTINCT {q.KEY}, "
        f"code, value FROM o_attr SEMI JOIN last USING ({q.KEY})) GROUP BY {q.KEY}",
    ),
    "snk6_info_documents": (info_documents, _info_doc_sql(_INFO_CHANGED)),
    "snk6_info_documents_ranked": (
        info_documents_ranked, _info_doc_sql(_INFO_CHANGED, length=LENGTH)
    ),
    "snk6_info_documents_paged": (info_documents_paged, _info_doc_sql(_INFO_CHANGED, PAGES)),
    "snk6_info_documents_compat": (
        info_documents_compat,
        _info_doc_sql(
            "SELECT entity_type, oid FROM (SELECT entity_type, oid, code, CASE WHEN code = 'M1' "
            "THEN value ELSE '' END FROM o_new EXCEPT SELECT entity_type, oid, code, "
            "CASE WHEN code = 'M1' THEN value ELSE '' END FROM o_old)"
        ),
    ),
}
