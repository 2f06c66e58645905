"""Nested and printable forms of profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.functions.keys import entity_key
from dossierlake.functions.times import time_text
from dossierlake.operators.attributes import SLOT
from dossierlake.operators.fold import days_text
from dossierlake.operators.parts import PAGE_ITEMS, gather
from dossierlake.schema import ENTITY, ROW_KEY


def nest_base(
    profile_base: DataFrame, pages: int | None = None, length: int = PAGE_ITEMS, placed: bool = False
) -> DataFrame:
    """Whole base profile: one row per row key and page with all its attributes.

    ``placed`` states that ``placing`` has dealt out all rows of a row key to one slot, which stays with them.
    """
    key = [*ROW_KEY, SLOT] if placed else ROW_KEY
    item = F.struct(
        "code", "value", "cnt", "first_time", "last_time", "day_cnt",
        F.array_sort(F.map_entries("days")).alias("days"),
    )
    return gather(profile_base, key, item, "props", ["code", "value"], pages, length, calm=placed)


def show_base(profile_base: DataFrame) -> DataFrame:
    """Attribute rows of base profiles with readable times and a sorted histogram."""
    return profile_base.select(
        *ROW_KEY, "code", "value", "cnt", "day_cnt",
        time_text(F.col("first_time")).alias("first_time"),
        time_text(F.col("last_time")).alias("last_time"),
        days_text(F.col("days")).alias("day_stats"),
    )


def show_info(profile_info: DataFrame) -> DataFrame:
    return profile_info.select(
        *ENTITY, "cnt", "day_cnt",
        time_text(F.col("first_time")).alias("first_time"),
        time_text(F.col("last_time")).alias("last_time"),
        days_text(F.col("days")).alias("day_stats"),
    )


def show_info_attributes(profile_info_attr: DataFrame) -> DataFrame:
    return profile_info_attr.select(
        *ENTITY, "code", "value", time_text(F.col("last_time")).alias("last_time")
    )


def show_observations(obs: DataFrame) -> DataFrame:
    """One printable line per observation, attributes as ``code=value``."""
    props = F.transform("props", lambda p: F.concat(p["code"], F.lit("="), p["value"]))
    return obs.select(
        "seq",
        entity_key(F.col("entity_type"), F.col("oid")).alias("md5"),
        *ROW_KEY,
        "capture_time",
        F.size("props").alias("n_props"),
        F.array_join(props, ",").alias("props"),
    )


def delimited_line(names: Sequence[str], delimiter: str = ",") -> Column:
    """The named fields in their order; a null prints as the text ``null``."""
    texts = [F.coalesce(F.col(n).cast("string"), F.lit("null")) for n in names]
    return F.concat_ws(delimiter, *texts).alias("value")


def delimited(
    rows: DataFrame, fields: Sequence[str] | None = None, delimiter: str = ","
) -> DataFrame:
    """One text column ``value``: all fields, or the listed ones."""
    return rows.select(delimited_line(fields or rows.columns, delimiter))
