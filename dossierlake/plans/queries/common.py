"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.operators.attributes import SLOT
from dossierlake.operators.fold import days_text
from dossierlake.operators.placing import Placing, placing
from dossierlake.plans.profiles import placed_attributes, placed_tables
from dossierlake.plans.store import SnapshotStore
from dossierlake.session import materialize, work_dir
from dossierlake.sources import adapters
from dossierlake.sources.adapters import DICTIONARY

LOADERS = {"e": adapters.load_events, "o": adapters.load_lines}
SPLITS = {"e": adapters.EVENTS_SPLIT, "o": adapters.LINES_SPLIT}
BUCKETS = 8


def flat(rows: DataFrame) -> DataFrame:
    """Scalar columns only: histograms as text, whole numbers as bigint."""
    columns = []
    for field in rows.schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(field.name)
        if kind.startswith("map<int"):
            column = days_text(column).alias(field.name)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint").alias(field.name)
        columns.append(column)
    return rows.select(*columns)


def placed_halves(spark: SparkSession, sf_dir: str, p: str) -> list[Placing]:
    """The stored and the new observations of a fixture, written once and dealt out by entity."""
    obs = materialize(LOADERS[p](spark, sf_dir), "observations")
    return [placing(half, written=True) for half in adapters.split_stored(obs, SPLITS[p])]


def sides(spark: SparkSession, sf_dir: str, p: str) -> tuple[dict, dict]:
    """Day tables of the stored and of the new observations of a fixture.

    They are written once, as they would lie in a store, and read by every later step.
    """
    old, new = (
        {name: materialize(rows.drop(SLOT), name) for name, rows in placed_tables(half, DICTIONARY).items()}
        for half in placed_halves(spark, sf_dir, p)
    )
    return old, new


def attr_sides(spark: SparkSession, sf_dir: str, p: str) -> tuple[DataFrame, DataFrame]:
    """Only the attribute day tables of both sides."""
    old, new = (
        materialize(placed_attributes(half, DICTIONARY).drop(SLOT), "attr_day")
        for half in placed_halves(spark, sf_dir, p)
    )
    return old, new


def fresh_store(spark: SparkSession, name: str) -> SnapshotStore:
    return SnapshotStore(spark, work_dir(spark, name), BUCKETS)
