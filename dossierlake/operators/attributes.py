"""Attribute rows: unpivot, multi-value split, repeats inside one observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.dictionary import MULTI, AttrDictionary
from dossierlake.functions.times import day_number
from dossierlake.schema import DIMENSIONS, OBS_HEADER, PROPS_TYPE, ROW_KEY

# Column with the day of an observation that ``dealt_by_day`` placed.
DAY = "day_"
# Column with the task that ``placing`` has dealt an observation out to; it follows from the row key and day.
SLOT = "slot_"

# Fixed value: what separates the values of a multi-valued cell.
VALUE_SEPARATOR = ","
# Everything up to the space counts as blank.
BLANKS = "".join(chr(i) for i in range(33))


def is_blank(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS)) == ""


def split_values(cell: Column, distinct: bool = False) -> Column:
    """Values of a multi-valued cell; blank parts go, the others stay untrimmed."""
    parts = F.filter(F.split(cell, VALUE_SEPARATOR), lambda v: ~is_blank(v))
    return F.array_distinct(parts) if distinct else parts


def code_pairs(code: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(code).alias("code"), v.alias("value")))


def with_header_defaults(obs: DataFrame) -> DataFrame:
    """A missing dimension is the empty text."""
    return obs.withColumns({d: F.coalesce(F.col(d), F.lit("")) for d in DIMENSIONS})


def dealt_by_day(obs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Observations by row key and day, with the day in ``day_``.

    A fold of their attributes then needs no further shuffle: an observation moves once, not
    once per attribute, and a task holds its share of the folded rows only. The number of tasks
    is stated, since adaptive execution would merge them by their size before rows multiply; it is
    the session's unless the caller, who may know how many observations there are, gives another.
    Observations that are dealt out already stay as they are.
    """
    if DAY in obs.columns:
        return obs
    parts = tasks or int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_header_defaults(obs).withColumn(DAY, day_number(F.col("capture_time")))
    return placed.repartition(parts, *near(ROW_KEY), DAY)


def near(key: list[str]) -> list[str]:
    """What rows of a key are dealt out by: a constant entity type drops out of the grouping
    that follows, and Spark would not see that the rows lie right."""
    return [c for c in key if c != "entity_type"]


def header_of(obs: DataFrame) -> list[str]:
    return [*OBS_HEADER, *[c for c in (DAY, SLOT) if c in obs.columns]]


def unpivot_attributes(
    wide: DataFrame, dictionary: AttrDictionary, distinct: bool = True
) -> DataFrame:
    """One row per attribute value of wide observations (header + one column per code).

    Columns the dictionary does not know are dropped, empty cells give no row. With
    ``distinct`` a value repeated inside one observation counts once. Everything is
    row-local: a generator inside the scan stage, no shuffle. Rows stay where they were dealt
    to, and a day that ``dealt_by_day`` added stays with them.
    """
    codes = [c for c in wide.columns if c in dictionary.kinds]
    header = header_of(wide)
    pairs = [F.struct(F.lit(c).alias("code"), F.col(c).alias("cell")) for c in codes]
    cells = (
        with_header_defaults(wide.select(*header, *codes))
        .select(*header, F.inline(F.array(*pairs)))
        .where(F.col("cell") != "")
    )
    multi = dictionary.is_kind(F.col("code"), MULTI)
    parts = F.split("cell", VALUE_SEPARATOR)
    values = F.when(multi, F.array_distinct(parts) if distinct else parts).otherwise(
        F.array("cell")
    )
    return cells.select(
        *header, "code", F.posexplode_outer(values).alias("pos", "value")
    ).where(~(multi & is_blank(F.col("value"))))


def collect_props(wide: DataFrame, dictionary: AttrDictionary) -> DataFrame:
    """Wide observations to observations with a ``props`` array, repeats kept."""
    parts = []
    for code in wide.columns:
        if code not in dictionary.kinds:
            continue
        cell = F.col(code)
        if dictionary.kinds[code] == MULTI:
            values = split_values(cell)
        else:
            values = F.array(cell)
        parts.append(
            F.when(cell != "", code_pairs(code, values)).otherwise(F.array().cast(PROPS_TYPE))
        )
    return with_header_defaults(wide.select(*OBS_HEADER, F.concat(*parts).alias("props")))


def distinct_props(props: Column) -> Column:
    """Each ``(code, value)`` once, at its last position."""
    return F.reverse(F.array_distinct(F.reverse(props)))


def last_single_props(props: Column, dictionary: AttrDictionary) -> Column:
    """Of a repeated single code only the last entry of the record stays."""
    return F.filter(
        props,
        lambda p, i: dictionary.is_kind(p["code"], MULTI)
        | ~F.exists(
            F.slice(props, i + 2, F.size(props)), lambda later: later["code"] == p["code"]
        ),
    )


def explode_props(obs: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per attribute of observations that carry a ``props`` array."""
    props = distinct_props(F.col("props")) if distinct else F.col("props")
    header = header_of(obs)
    return (
        with_header_defaults(obs)
        .select(*header, F.posexplode_outer(props).alias("pos", "attr"))
        .select(*header, "attr.code", "pos", "attr.value")
        .where(F.col("code").isNotNull())
    )


def with_fold_kind(attrs: DataFrame, dictionary: AttrDictionary) -> DataFrame:
    return attrs.withColumn("kind", dictionary.fold_kind(F.col("code")))
