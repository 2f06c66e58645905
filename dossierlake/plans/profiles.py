"""Building profiles and keeping them in a store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.dictionary import AttrDictionary
from dossierlake.functions.keys import row_key
from dossierlake.operators.attributes import DAY, dealt_by_day, explode_props, unpivot_attributes
from dossierlake.operators.documents import (
    base_documents,
    base_json,
    base_rows_to_index,
    info_documents,
    info_entities_to_index,
    info_json,
    write_documents,
)
from dossierlake.operators.fold import (
    ATTR_DAY_KEY,
    ENTITY_DAY_KEY,
    base_profile,
    fold_attr_day,
    fold_entity_day,
    info_attributes,
    info_profile,
    merge_attr_day,
    merge_entity_day,
)
from dossierlake.operators.lookup import without_entities
from dossierlake.operators.merge import classify, keep_keys
from dossierlake.operators.parts import PAGE_ITEMS, page_of
from dossierlake.operators.placing import Placing, placing
from dossierlake.plans.store import SnapshotStore
from dossierlake.schema import ATTR_KEY, ENTITY, ROW_KEY
from dossierlake.session import materialize

MERGES = {"attr_day": merge_attr_day, "entity_day": merge_entity_day}
# Arrival numbers of one batch.
BATCH_ROOM = 10**12
# Day rows of a row key that lie together when its status is joined.
BUSY_ROWS = 100_000
DAY_KEYS = {"attr_day": ATTR_DAY_KEY, "entity_day": ENTITY_DAY_KEY}


@dataclass
class Profiles:
    base: DataFrame
    info: DataFrame
    info_attr: DataFrame


def attribute_rows(
    obs: DataFrame, dictionary: AttrDictionary, count_repeats: bool = False
) -> DataFrame:
    """Attribute rows of wide observations or of observations with ``props``."""
    if "props" in obs.columns:
        return explode_props(obs, distinct=not count_repeats)
    return unpivot_attributes(obs, dictionary, distinct=not count_repeats)


def fold_attributes(
    obs: DataFrame, dictionary: AttrDictionary, count_repeats: bool = False, tasks: int | None = None
) -> DataFrame:
    """``attr_day`` of observations, which are dealt out before they become attribute rows."""
    return fold_attr_day(attribute_rows(dealt_by_day(obs, tasks), dictionary, count_repeats))


def day_tables(
    obs: DataFrame, dictionary: AttrDictionary, count_repeats: bool = False, tasks: int | None = None
) -> dict[str, DataFrame]:
    return {
        "attr_day": fold_attributes(obs, dictionary, count_repeats, tasks),
        "entity_day": fold_entity_day(obs),
    }


def placed_attributes(obs: Placing, dictionary: AttrDictionary, count_repeats: bool = False) -> DataFrame:
    return fold_attr_day(attribute_rows(obs.all(), dictionary, count_repeats))


def placed_tables(
    obs: Placing, dictionary: AttrDictionary, count_repeats: bool = False
) -> dict[str, DataFrame]:
    """The same from written observations; rows keep their slot, which lies in one bucket of the store."""
    return {
        "attr_day": placed_attributes(obs, dictionary, count_repeats),
        "entity_day": fold_entity_day(obs.entity_times()),
    }


def merge_tables(*sides: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Day tables folded into one; ``attr_day`` lies by ``ATTR_KEY``."""
    return {
        "attr_day": merge_attr_day(*[s["attr_day"] for s in sides], by=ATTR_KEY),
        "entity_day": merge_entity_day(*[s["entity_day"] for s in sides]),
    }


def profiles_of(
    tables: dict[str, DataFrame],
    dictionary: AttrDictionary,
    placed: bool = False,
    partial: DataFrame | None = None,
) -> Profiles:
    """Profiles from day tables with one row per key and day.

    Info attributes are taken from ``partial`` day rows if there are any: they need no merge.
    """
    return Profiles(
        base_profile(tables["attr_day"], placed),
        info_profile(tables["entity_day"]),
        info_attributes(tables["attr_day"] if partial is None else partial, dictionary),
    )


def build_profiles(
    obs: DataFrame, dictionary: AttrDictionary, count_repeats: bool = False
) -> Profiles:
    return profiles_of(day_tables(obs, dictionary, count_repeats), dictionary)


# -- store --------------------------------------------------------------------------


def after_batches(obs: DataFrame, number: int) -> DataFrame:
    """Arrival numbers of a batch that follow those of all batches with smaller numbers."""
    if number >= (2**63 - 1) // BATCH_ROOM:
        raise ValueError(f"batch number {number} is too large")
    seq = F.col("seq")
    wrong = F.raise_error(F.concat(F.lit("arrival number out of range: "), seq.cast("string")))
    inside = (seq >= 0) & (seq < BATCH_ROOM)
    placed = F.when(inside, seq + F.lit(number * BATCH_ROOM)).otherwise(wrong.cast("bigint"))
    return obs.withColumn("seq", placed)


def ingest(
    store: SnapshotStore,
    obs: DataFrame,
    dictionary: AttrDictionary,
    batch_id: str,
    count_repeats: bool = False,
    by_batch: bool = False,
) -> int:
    """Merge a batch of observations: its partial fold becomes one more segment.

    The cost grows with the batch, not with the store. ``by_batch`` is for arrival numbers
    that begin anew in each batch, such as positions in files: earlier batches arrived
    earlier. Observations that are not dealt out yet are written once and move to the slots of the
    store's buckets, so that day rows are written where they are folded.
    """
    if by_batch:
        head = store.head()
        obs = after_batches(obs, head["version"] + 1 if head else 1)
    if DAY in obs.columns:
        return store.append(day_tables(obs, dictionary, count_repeats), batch_id)
    if store.has_batch(batch_id):
        return store.head()["version"]
    return store.append(placed_tables(placing(obs, store.buckets), dictionary, count_repeats), batch_id)


def raw_tables(store: SnapshotStore, version: int | None = None) -> dict[str, DataFrame]:
    """Day rows of a version as they lie in its segments."""
    raw = {name: store.read(name, version) for name in MERGES}
    if any(table is None for table in raw.values()):
        raise ValueError(f"the store at {store.root} is empty")
    return raw


def stored_tables(store: SnapshotStore, version: int | None = None) -> dict[str, DataFrame]:
    """Day tables of a version, merged over its segments."""
    return merge_tables(raw_tables(store, version))


def stored_profiles(
    store: SnapshotStore, dictionary: AttrDictionary, version: int | None = None
) -> Profiles:
    raw = raw_tables(store, version)
    return profiles_of(merge_tables(raw), dictionary, placed=True, partial=raw["attr_day"])


def find_in_store(
    store: SnapshotStore, match: Column, dictionary: AttrDictionary
) -> Profiles:
    """Profiles of the entities that match; the predicate reaches the store's files."""
    raw = {name: store.read(name).where(match) for name in MERGES}
    return profiles_of(merge_tables(raw), dictionary, placed=True, partial=raw["attr_day"])


def find_many_in_store(
    store: SnapshotStore, keys: DataFrame, dictionary: AttrDictionary
) -> Profiles:
    """Profiles of all entities of a key table in one job.

    Only the buckets of the keys are listed, and the rows are narrowed to the keys before
    they are merged. Info attributes are narrowed once they are aggregated, where they are few
    and day rows need not move; Spark narrows before that if it broadcasts the keys.
    """
    near = {"attr_day": ATTR_KEY, "entity_day": ENTITY_DAY_KEY}
    buckets = store.touched_buckets(keys)
    raw = {name: stored_of(store, name, keys, next_key=near[name], buckets=buckets) for name in MERGES}
    tables = {name: merge(raw[name]) for name, merge in MERGES.items()}
    found = profiles_of(tables, dictionary, placed=True, partial=in_buckets(store, "attr_day", buckets))
    found.info_attr = keep_keys(found.info_attr, keys, ENTITY)
    return found


def in_buckets(store: SnapshotStore, table: str, buckets: list[int], version: int | None = None) -> DataFrame | None:
    rows = store.read(table, version)
    return None if rows is None else rows.where(F.col("bucket").isin(*buckets))


def stored_of(
    store: SnapshotStore,
    table: str,
    keys: DataFrame,
    version: int | None = None,
    next_key: list[str] | None = None,
    buckets: list[int] | None = None,
) -> DataFrame | None:
    """Stored rows of the entities of a key table; only their buckets are listed.

    They are dealt out by ``next_key``, which is the table's own key unless stated.
    """
    rows = in_buckets(store, table, store.touched_buckets(keys) if buckets is None else buckets, version)
    return None if rows is None else keep_keys(rows, keys, ENTITY, next_key=next_key or DAY_KEYS[table])


def compact(store: SnapshotStore, batch_id: str) -> int:
    return store.compact(MERGES, batch_id)


def delete_entities(
    store: SnapshotStore,
    keys: DataFrame,
    batch_id: str,
    base: bool = True,
    info: bool = True,
) -> int:
    """Remove entities from base, info or both; only their buckets are rewritten.

    The keys may come from a long job of their own, so they are made once.
    """
    keys = materialize(keys.select(*ENTITY).distinct(), "gone-keys")
    touched = store.touched_buckets(keys)
    chosen = [name for name, on in (("attr_day", base), ("entity_day", info)) if on]
    tables = {}
    for name in chosen:
        rows = store.read(name).where(F.col("bucket").isin(*touched)).drop("bucket")
        tables[name] = MERGES[name](without_entities(rows, keys, DAY_KEYS[name]))
    return store.rewrite(tables, batch_id, touched)


def merge_snapshots(
    stored: dict[str, DataFrame], new: dict[str, DataFrame], path: str
) -> None:
    """File-to-file merge: the merged base profile split by ``status`` of its row key."""
    merged = merged_with_status(stored["attr_day"], new["attr_day"])
    merged.write.partitionBy("status").mode("errorifexists").parquet(path)


def merged_with_status(stored: DataFrame, new: DataFrame, busy: int = BUSY_ROWS) -> DataFrame:
    """Merged base profile of two ``attr_day`` tables with the status of its row key.

    Day rows move once, by row key and page: the days of a value, and the values and status of a
    row key, then lie together. Row keys with more than ``busy`` day rows have as many more pages,
    and their status is there for each; a value's page follows from its digest.
    """
    status = materialize(classify(stored, new, sizes=True), "status")
    status = status.withColumn("pages", F.ceil(F.col("rows") / busy).cast("int")).drop("rows")
    # At most one row for every ``busy`` day rows.
    paged = materialize(status.where("pages > 1").select(*ROW_KEY, "pages"), "paged")
    page = F.when(F.col("pages") > 1, page_of(F.col("pages"), "code", "value")).otherwise(0)
    days = stored.unionByName(new).join(paged, ROW_KEY, "left").withColumn("page", page)
    lie = [*ROW_KEY, "page"]
    days = merge_attr_day(days.repartition(*lie), also=("page",))
    merged = base_profile(days, placed=True, also=("page",))
    every = F.explode(F.sequence(F.lit(0), F.col("pages") - 1))
    status = status.withColumn("page", every).drop("pages")
    return merged.join(status.hint("merge"), lie).drop("page")


def merge_info_snapshots(
    stored: dict[str, DataFrame], new: dict[str, DataFrame], path: str
) -> None:
    """The same for info profiles: split by ``status`` of the entity."""
    merged = info_profile(merge_entity_day(stored["entity_day"], new["entity_day"]))
    status = classify(stored["entity_day"], new["entity_day"], ENTITY)
    merged.join(status, ENTITY).write.partitionBy("status").mode("errorifexists").parquet(path)


def export_changed(
    serving: SnapshotStore, stored: DataFrame | None, new: DataFrame, batch_id: str
) -> int:
    """Upsert the base profiles that new data changes, under their row keys.

    ``stored`` and ``new`` are ``attr_day`` tables. Stored rows are narrowed to the changed
    row keys before anything is merged.
    """
    touched = new.select(*ROW_KEY).distinct()
    parts = [new]
    if stored is not None:
        parts.append(keep_keys(stored, touched, ROW_KEY))
    changed = with_row_key(base_profile(merge_attr_day(*parts, by=ATTR_KEY), placed=True))
    return _upsert(serving, "base", changed, touched, ROW_KEY, batch_id)


def export_changed_info(
    serving: SnapshotStore, stored: DataFrame | None, new: DataFrame, batch_id: str
) -> int:
    """Upsert the info profiles that new data changes; both are ``entity_day`` tables."""
    touched = new.select(*ENTITY).distinct()
    parts = [new]
    if stored is not None:
        parts.append(keep_keys(stored, touched, ENTITY, next_key=ENTITY_DAY_KEY))
    changed = info_profile(merge_entity_day(*parts))
    return _upsert(serving, "info", changed, touched, ENTITY, batch_id)


def _upsert(
    serving: SnapshotStore,
    table: str,
    changed: DataFrame,
    touched: DataFrame,
    key: list[str],
    batch_id: str,
) -> int:
    """Replace the rows of the touched keys; only their buckets are rewritten."""
    current = serving.read(table)
    if current is None:
        return serving.append({table: changed}, batch_id)
    buckets = serving.touched_buckets(touched.select(*ENTITY))
    kept = (
        current.where(F.col("bucket").isin(*buckets))
        .drop("bucket")
        .join(touched, key, "left_anti")
    )
    return serving.rewrite({table: kept.unionByName(changed)}, batch_id, buckets)


def with_row_key(base: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in ROW_KEY]
    return base.withColumn("row_key", row_key(*cols))


def load(
    store: SnapshotStore,
    obs: DataFrame,
    dictionary: AttrDictionary,
    batch_id: str,
    as_of: int | None = None,
    documents_path: str | None = None,
    by_batch: bool = False,
    page_items: int = PAGE_ITEMS,
) -> int:
    """One-step load: fold, merge into the store and write the search documents.

    The new segment is written first and read back, so the observations are folded once.
    A batch that is already stored gets its documents again: its segment is compared with
    the version before it, whatever came later, and its folder is overwritten. Of the store
    only the batch's entities are read. A document has at most ``page_items`` values.
    """
    ingest(store, obs, dictionary, batch_id, by_batch=by_batch)
    version = store.version_of(batch_id)
    if documents_path is None:
        return version
    arrived = store.newest("attr_day", version)
    keys = arrived.select(*ENTITY).distinct()
    after = stored_of(store, "attr_day", keys, version)
    old = stored_of(store, "attr_day", keys, version - 1) if version > 1 else None
    if old is None:
        old = after.limit(0)
    moment = F.lit(as_of) if as_of is not None else F.unix_timestamp()
    rows = base_rows_to_index(old, arrived)
    base_docs = base_documents(after, moment, rows, length=page_items)
    write_documents(base_json(base_docs), f"{documents_path}/base", "overwrite")
    entities = info_entities_to_index(old, arrived, dictionary)
    info_docs = info_documents(
        info_attributes(after, dictionary), moment, entities, length=page_items
    )
    write_documents(info_json(info_docs), f"{documents_path}/info", "overwrite")
    return version
