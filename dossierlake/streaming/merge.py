"""Keeping profiles up to date from a stream of observations.

The stream uses the batch fold: each micro-batch is folded and added to the store as one
segment. The checkpoint replays a failed batch with the same number and content, and the
store skips a batch id it has already listed, so every observation counts once. There is
no watermark: observations of any age are merged. A batch is dealt out as it arrives, so that no
task folds a whole file of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dossierlake.dictionary import AttrDictionary
from dossierlake.operators.attributes import dealt_by_day
from dossierlake.operators.fold import fold_attr_day
from dossierlake.operators.merge import new_values
from dossierlake.plans.profiles import attribute_rows, compact, ingest, stored_of
from dossierlake.plans.store import SnapshotStore
from dossierlake.schema import ATTR_KEY, ENTITY

# Segments after which a stream folds the store into one.
COMPACT_EVERY = 64


def start_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_profile_merge(
    stream: DataFrame,
    store: SnapshotStore,
    dictionary: AttrDictionary,
    checkpoint: str,
    stream_id: str,
    trigger: dict | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Merge base and info profiles from a stream into the store.

    ``stream_id`` names the stream's checkpoint in the store's log; a stream that starts
    over with a new checkpoint needs a new one.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}:{number}"
        batch = dealt_by_day(batch).persist()
        try:
            if batch.isEmpty():
                return
            ingest(store, batch, dictionary, batch_id)
        finally:
            batch.unpersist()
        if store.segment_count("attr_day") >= compact_every:
            compact(store, f"{batch_id}:compact")

    return start_each_batch(stream, merge_batch, checkpoint, trigger=trigger)


def run_to_end(start: Callable[[], StreamingQuery], restarts: int = 3) -> int:
    """Runs a query that ends by itself; one that fails starts again from its checkpoint.

    Returns how often it was started again. A failure after the last restart is raised.
    """
    for attempt in range(restarts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == restarts:
                raise
    raise ValueError(f"negative number of restarts: {restarts}")


def running_attr_day(stream: DataFrame, dictionary: AttrDictionary) -> DataFrame:
    """The attribute fold as a stateful streaming aggregation (output mode ``update``)."""
    return fold_attr_day(attribute_rows(stream, dictionary))


def first_seen(stream: DataFrame, dictionary: AttrDictionary) -> DataFrame:
    """Change feed: each (row key, code, value) once, when it is first seen.

    Stand-alone form; its state grows with the distinct values, as the store does.
    """
    return attribute_rows(stream, dictionary).select(*ATTR_KEY).dropDuplicates()


def start_change_feed(
    stream: DataFrame,
    store: SnapshotStore,
    dictionary: AttrDictionary,
    feed_path: str,
    checkpoint: str,
    stream_id: str,
    trigger: dict | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Change feed against the store: values of a batch that the store did not know.

    The feed of a batch is written before the batch enters the store, into a folder of
    its own that a replay overwrites. Only the buckets of the batch's entities are read.
    """

    def feed_batch(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}:{number}"
        if store.has_batch(batch_id):
            return
        batch = dealt_by_day(batch).persist()
        try:
            if batch.isEmpty():
                return
            arriving = attribute_rows(batch, dictionary).select(*ATTR_KEY)
            known = stored_of(store, "attr_day", batch.select(*ENTITY))
            fresh = arriving.distinct() if known is None else new_values(known, arriving)
            fresh.write.mode("overwrite").parquet(f"{feed_path}/batch_id={number}")
            ingest(store, batch, dictionary, batch_id)
        finally:
            batch.unpersist()
        if store.segment_count("attr_day") >= compact_every:
            compact(store, f"{batch_id}:compact")

    return start_each_batch(stream, feed_batch, checkpoint, trigger=trigger)
