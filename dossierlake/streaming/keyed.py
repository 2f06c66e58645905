"""Day tables of a stream in keyed state: each batch touches its own keys and nothing else.

The state is that of the fold, one row per key and day, in RocksDB below the checkpoint. Stored day tables
seed it: they are the first rows of the same stream, since folding partials and merging them is
one aggregation. Every batch writes the rows it changed, as they are after it, to a folder of its own that
a replay overwrites; the newest row of a key is its current one. Nothing is ever folded again as a whole.
There is no watermark, data of any age is merged, so the state grows as the profiles do.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossierlake.dictionary import AttrDictionary
from dossierlake.operators.fold import (
    ATTR_DAY,
    ATTR_DAY_KEY,
    ENTITY_DAY,
    ENTITY_DAY_KEY,
    attr_day_rows,
    entity_day_rows,
    merge_attr_day,
    merge_entity_day,
)
from dossierlake.plans.profiles import attribute_rows

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = {"attr_day": ATTR_DAY_KEY, "entity_day": ENTITY_DAY_KEY}
COLUMNS = {"attr_day": ATTR_DAY, "entity_day": ENTITY_DAY}
MERGES = {"attr_day": merge_attr_day, "entity_day": merge_entity_day}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """A query that starts inside keeps its state in RocksDB, also when it is restarted later."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def partial_rows(stream: DataFrame, dictionary: AttrDictionary, table: str) -> DataFrame:
    """Each observation's share of a day table."""
    if table == "attr_day":
        return attr_day_rows(attribute_rows(stream, dictionary))
    return entity_day_rows(stream)


def keyed_table(
    stream: DataFrame, dictionary: AttrDictionary, table: str, seed: DataFrame | None = None
) -> DataFrame:
    """The day table as a stateful aggregation (output mode ``update``).

    ``seed`` is a stream over stored rows of the table, such as ``readStream`` of its segments.
    """
    parts = [partial_rows(stream, dictionary, table)]
    if seed is not None:
        parts.append(seed.select(*COLUMNS[table]))
    return MERGES[table](*parts)


def start_keyed(
    stream: DataFrame,
    dictionary: AttrDictionary,
    table: str,
    changes: str,
    checkpoint: str,
    seed: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Runs the aggregation and writes the rows that each batch changed below ``changes``.

    A restart passes the same sources, ``seed`` included: the checkpoint knows what of them it has read.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch_id={number}")

    spark = stream.sparkSession
    rows = keyed_table(stream, dictionary, table, seed)
    with rocksdb_state(spark):
        writer = rows.writeStream.outputMode("update").foreachBatch(write)
        writer = writer.option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def current_rows(spark: SparkSession, changes: str, table: str) -> DataFrame:
    """The newest row of every key: the table after the last finished batch."""
    rows = spark.read.parquet(changes)
    values = [c for c in COLUMNS[table] if c not in KEYS[table]]
    newest = F.max(F.struct("batch_id", *values)).alias("newest")
    kept = rows.groupBy(*KEYS[table]).agg(newest)
    return kept.select(*KEYS[table], *[F.col(f"newest.{c}").alias(c) for c in values])
