"""What the store holds under the row keys of a stream, as of the version current at each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossierlake.dictionary import AttrDictionary
from dossierlake.operators.merge import stored_lookup
from dossierlake.plans.profiles import ingest, stored_of
from dossierlake.plans.store import SnapshotStore
from dossierlake.schema import ATTR_KEY, ENTITY
from dossierlake.streaming.merge import start_each_batch


def look_up(batch: DataFrame, store: SnapshotStore) -> DataFrame:
    """The batch's row keys with what the store's newest version holds, and that version (0: none).

    The version is fixed once, so a commit that happens meanwhile is not half seen. Only the
    buckets of the batch's entities are listed, and their rows are narrowed to these entities.
    """
    head = store.head()
    version = head["version"] if head else 0
    rows = stored_of(store, "attr_day", batch.select(*ENTITY), version) if head else None
    if rows is None:
        kinds = [f"{name} string" for name in ATTR_KEY] + ["first_time bigint", "last_time bigint"]
        held = store.spark.createDataFrame([], ", ".join(kinds))
    else:
        held = rows.groupBy(*ATTR_KEY).agg(
            F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
        )
    return stored_lookup(batch, held).withColumn("version", F.lit(version).cast("bigint"))


def start_stored_lookup(
    stream: DataFrame,
    store: SnapshotStore,
    found_path: str,
    checkpoint: str,
    stream_id: str,
    merge_with: AttrDictionary | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the lookup of each batch to a folder of its own.

    With a dictionary in ``merge_with`` the batch enters the store after its lookup, so the next batch
    sees it. A replay overwrites the batch's folder with a lookup in the version current then; a
    batch that the store has listed already keeps the lookup made before it entered.
    """

    def find_batch(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}:{number}"
        if store.has_batch(batch_id):
            return
        batch.persist()
        try:
            if batch.isEmpty():
                return
            found = look_up(batch, store)
            found.write.mode("overwrite").parquet(f"{found_path}/batch_id={number}")
            if merge_with is not None:
                ingest(store, batch, merge_with, batch_id)
        finally:
            batch.unpersist()

    return start_each_batch(stream, find_batch, checkpoint, trigger=trigger)
