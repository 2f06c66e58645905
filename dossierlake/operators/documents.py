"""Search documents of base and info profiles, and which of them a batch must emit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.dictionary import MULTI, AttrDictionary
from dossierlake.functions.keys import base_document_id, info_document_id
from dossierlake.operators.attributes import with_fold_kind
from dossierlake.operators.merge import keep_keys, new_values, union_inputs
from dossierlake.operators.parts import PAGE_ITEMS, Dealing, gather, with_page
from dossierlake.schema import ATTR_KEY, ENTITY, ROW_KEY
from dossierlake.session import materialize

# Document field names.
FIELD_TIME = "H010014"
FIELD_TYPE = "A010001"
FIELD_OID = "A010002"
FIELD_DATA_SOURCE = "B050016"
FIELD_PROTOCOL = "H010001"
FIELD_ACTION = "H010003"


def base_rows_to_index(stored: DataFrame, new: DataFrame, by: Dealing | None = None) -> DataFrame:
    """Row keys that gained a value the store did not have.

    ``by`` deals out both sides by row key, so that all of a row key lies together and moves once.
    """
    if by is None:
        return new_values(stored, new).select(*ROW_KEY).distinct()
    calm, busy = by.split(union_inputs(stored.select(*ATTR_KEY), new.select(*ATTR_KEY)))
    found = _gained(calm)
    return found if busy is None else found.unionByName(_gained(busy.repartition(by.tasks, *ATTR_KEY)))


def _gained(both: DataFrame) -> DataFrame:
    """The rows of ``base_rows_to_index`` by one aggregation; a null matches nothing, as in a join."""
    values = both.groupBy(*ATTR_KEY).agg(
        F.max(F.col("src") == "store").alias("held"), F.max(F.col("src") == "new").alias("arrived")
    )
    null = reduce(Column.__or__, [F.col(c).isNull() for c in ATTR_KEY])
    return values.where(F.col("arrived") & (~F.col("held") | null)).select(*ROW_KEY).distinct()


def base_documents(
    attr_day: DataFrame,
    as_of: Column,
    rows: DataFrame | None = None,
    compat_ids: bool = False,
    pages: int | None = None,
    length: int = PAGE_ITEMS,
    by: Dealing | None = None,
) -> DataFrame:
    """One document per row key: ``props`` is a list of ``{code: value}``.

    ``rows`` limits the output to some row keys. With ``compat_ids`` the id ignores
    protocol and action, and of the rows that share it the last one (by time, then by
    its own protocol and action) is the document. A row key with more than ``length`` values
    has a document for each page of them; the page ends the id from the second on. With a
    stated number of ``pages`` a value's page follows from its digest and ends every id.

    ``by`` deals out the day rows by row key, which then move once; only those of busy row keys move
    as they do without it.
    """
    if by is None:
        if rows is not None:
            attr_day = keep_keys(attr_day, rows, ROW_KEY, next_key=ATTR_KEY)
        if compat_ids:
            attr_day = keep_keys(attr_day, _last_rows(attr_day), ROW_KEY, next_key=ATTR_KEY)
        docs = _props(attr_day, pages, length)
    else:
        if compat_ids:
            # The last rows are found among row keys, so day rows are only narrowed once.
            rows = _last_rows(attr_day, rows)
        calm, busy = by.split(attr_day.select(*ATTR_KEY))
        if rows is not None:
            rows = rows.select(*ROW_KEY).distinct()
            rows = rows if busy is None else materialize(rows, "rows")
            # Spark would move a semi join to the day rows as they lie, and deal out twice.
            calm = calm.join(by.deal(rows), ROW_KEY)
        docs = _props(calm, pages, length, calm=True)
        if busy is not None:
            if rows is not None:
                busy = keep_keys(busy, rows, ROW_KEY, next_key=ATTR_KEY)
            docs = docs.unionByName(_props(busy, pages, length))
    cols = {name: F.col(name) for name in ROW_KEY}
    return docs.select(
        paged_id(base_document_id(cols, compat_ids), pages).alias("id"),
        "page",
        as_of.cast("bigint").alias(FIELD_TIME),
        F.col("entity_type").alias(FIELD_TYPE),
        F.col("oid").alias(FIELD_OID),
        F.col("data_source").alias(FIELD_DATA_SOURCE),
        F.col("protocol").alias(FIELD_PROTOCOL),
        F.col("action").alias(FIELD_ACTION),
        F.transform("props", lambda p: F.create_map(p["code"], p["value"])).alias("props"),
    )


def _props(attr_day: DataFrame, pages: int | None, length: int, calm: bool = False) -> DataFrame:
    values = attr_day.select(*ROW_KEY, "code", "value").distinct()
    # Maps as items cannot be sorted, so the pairs are sorted first.
    return gather(
        values, ROW_KEY, F.struct("code", "value"), "props", ["code", "value"], pages, length, calm=calm
    )


def paged_id(document_id: Column, pages: int | None) -> Column:
    if pages == 1:
        return document_id
    ended = F.concat(document_id, F.lit("-"), F.col("page"))
    return ended if pages else F.when(F.col("page") == 0, document_id).otherwise(ended)


def _last_rows(attr_day: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Row key of the last row of each source, among ``rows`` if they are stated."""
    source = [*ENTITY, "data_source"]
    times = attr_day.groupBy(*ROW_KEY).agg(F.max("last_time").alias("row_time"))
    return (
        (times if rows is None else keep_keys(times, rows, ROW_KEY))
        .groupBy(*source)
        .agg(F.max(F.struct("row_time", "protocol", "action")).alias("w"))
        .select(*source, "w.protocol", "w.action")
    )


def info_entities_to_index(
    stored: DataFrame,
    new: DataFrame,
    dictionary: AttrDictionary,
    compat_trigger: bool = False,
) -> DataFrame:
    """Entities whose info document the new data changes.

    By default any changed value counts. ``compat_trigger`` only reacts to a code or a
    multi value that is new to the entity. One aggregation compares the best value of
    the store with the best of both sides.
    """
    both = with_fold_kind(union_inputs(stored, new), dictionary)
    slot = F.when(F.col("kind") == MULTI, F.col("value")).otherwise(F.lit(""))
    best = F.struct("latest", "value")
    slots = both.groupBy(*ENTITY, "code", "kind", slot.alias("slot")).agg(
        F.max(best).alias("after"),
        F.max(F.when(F.col("src") == "store", best)).alias("before"),
    )
    changed = F.col("before").isNull()
    if not compat_trigger:
        changed = changed | (F.col("before.value") != F.col("after.value"))
    return slots.where(changed).select(*ENTITY).distinct()


def info_documents(
    profile_info_attr: DataFrame,
    as_of: Column,
    entities: DataFrame | None = None,
    pages: int | None = None,
    length: int = PAGE_ITEMS,
) -> DataFrame:
    """One document per entity: ``single`` maps a code to its value, ``multi`` to values.

    ``info_json`` turns it into the flat document. Pages are those of ``base_documents``.
    """
    attrs = profile_info_attr
    if entities is not None:
        attrs = keep_keys(attrs, entities, ENTITY, next_key=[*ENTITY, "code", "value"])
    values = attrs.select(*ENTITY, "code", "kind", "value")
    paged = with_page(values, ENTITY, ["code", "value"], pages, length)
    # Per code first, so that the last step sees one row per code of the entity.
    codes = paged.groupBy(*ENTITY, "page", "code", "kind").agg(
        F.sort_array(F.collect_list("value")).alias("values")
    )
    multi = F.col("kind") == MULTI
    docs = codes.groupBy(*ENTITY, "page").agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(F.when(~multi, F.struct("code", F.col("values")[0])))
            )
        ).alias("single"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(multi, F.struct("code", "values"))))
        ).alias("multi"),
    )
    return docs.select(
        paged_id(info_document_id(F.col("entity_type"), F.col("oid")), pages).alias("id"),
        "page",
        as_of.cast("bigint").alias(FIELD_TIME),
        F.col("entity_type").alias(FIELD_TYPE),
        F.col("oid").alias(FIELD_OID),
        "single",
        "multi",
    )


def base_json(docs: DataFrame) -> DataFrame:
    """Documents as JSON lines."""
    return docs.select(
        F.to_json(F.struct(*docs.columns)).alias("value")
    )


def info_json(docs: DataFrame) -> DataFrame:
    """Flat JSON lines: every single code a field, every multi code an array field."""
    head = [c for c in docs.columns if c not in ("single", "multi")]
    texts = [
        F.to_json(F.struct(*head)),
        F.to_json("single"),
        F.to_json("multi"),
    ]
    # Joining objects: drop the braces and the empty ones.
    inner = F.filter(
        F.array(*[F.substring(t, F.lit(2), F.length(t) - 2) for t in texts]),
        lambda t: t != "",
    )
    return docs.select(
        F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}")).alias("value")
    )


def write_documents(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.write.mode(mode).text(path)
