"""Observations dealt out by entity, so that what follows is folded where they lie.

The salts of entities are cut into even slots, one for each task, as ``bucket_of`` cuts them into buckets: a
slot lies in one bucket of a store if the number of slots is a multiple of its buckets. A slot with more than
``FULL_SLOT`` observations is looked into. Its entities with more than ``BUSY_OBSERVATIONS`` are busy; their
observations are dealt out by row key and day instead, among the slots of their bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.functions.keys import bucket_of
from dossierlake.functions.times import day_number
from dossierlake.operators.attributes import DAY, SLOT, with_header_defaults
from dossierlake.schema import ENTITY, ROW_KEY
from dossierlake.session import materialize

# Observations of a task, and those below which it is not worth one while the session has enough tasks.
SLOT_OBSERVATIONS = 100_000
SMALL_SLOT = 20_000
# Observations of a slot from which on its entities are counted, and of an entity that is dealt out by itself.
FULL_SLOT = 300_000
BUSY_OBSERVATIONS = 100_000


@dataclass
class Placing:
    """Written observations and how they are dealt out; ``busy`` holds digests of the busy entities."""

    obs: DataFrame
    slots: int
    buckets: int
    busy: DataFrame | None

    def all(self) -> DataFrame:
        """All observations by slot; with it, rows of a row key and day lie in one task."""
        return self._dealt(self._slotted(ROW_KEY))

    def entity_times(self) -> DataFrame:
        """Entity and time of all observations by slot; those of an entity and day lie in one task."""
        return self._dealt(self._slotted(ENTITY).select(*ENTITY, "capture_time", DAY, SLOT))

    def calm(self) -> DataFrame:
        """Observations of entities that are not busy, all of an entity in one task."""
        obs = self.obs if self.busy is None else self._joined("left_anti")
        return self._dealt(with_day(obs).withColumn(SLOT, slot_of(self.slots)))

    def busy_ones(self) -> DataFrame | None:
        """The other observations as they lie."""
        return None if self.busy is None else self._joined("left_semi")

    def _joined(self, how: str) -> DataFrame:
        return self.obs.join(F.broadcast(self.busy), F.xxhash64(*ENTITY) == self.busy["key_"], how)

    def _slotted(self, key: list[str]) -> DataFrame:
        slot = slot_of(self.slots)
        if self.busy is None:
            return with_day(self.obs).withColumn(SLOT, slot)
        each = self.slots // self.buckets
        spread = slot_of(self.buckets) * each + F.pmod(F.xxhash64(*key, DAY), F.lit(each)).cast("int")
        rows = with_day(self._joined("left"))
        return rows.withColumn(SLOT, F.when(F.col("key_").isNull(), slot).otherwise(spread)).drop("key_")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartitionById(self.slots, F.col(SLOT))


def with_day(obs: DataFrame) -> DataFrame:
    return with_header_defaults(obs).withColumn(DAY, day_number(F.col("capture_time")))


def slot_of(slots: int):
    return bucket_of(F.col("entity_type"), F.col("oid"), slots)


def slots_for(spark, rows: int, buckets: int = 1) -> int:
    """Slots for so many observations: a task's share stays bounded, and small ones are not cut further."""
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(session, rows // SMALL_SLOT), -(-rows // SLOT_OBSERVATIONS))
    return -(-tasks // buckets) * buckets


def placing(
    obs: DataFrame, buckets: int = 1, full: int = FULL_SLOT, most: int = BUSY_OBSERVATIONS, written: bool = False
) -> Placing:
    """Writes observations, unless they are ``written``, and finds out how to deal them out."""
    obs = obs if written else materialize(obs, "observations")
    slots = slots_for(obs.sparkSession, obs.count(), buckets)
    sizes = obs.groupBy(slot_of(slots).alias(SLOT)).agg(F.count(F.lit(1)).alias("rows_"))
    # At most one number for every ``full`` observations.
    crowded = [r[0] for r in sizes.where(F.col("rows_") > full).select(SLOT).collect()]
    if not crowded:
        return Placing(obs, slots, buckets, None)
    inside = obs.where(slot_of(slots).isin(crowded)).groupBy(F.xxhash64(*ENTITY).alias("key_"))
    counts = inside.agg(F.count(F.lit(1)).alias("rows_")).where(F.col("rows_") > most)
    busy = materialize(counts.select("key_"), "busy")
    return Placing(obs, slots, buckets, None if busy.isEmpty() else busy)
