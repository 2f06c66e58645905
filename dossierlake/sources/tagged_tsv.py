"""Tagged tab-separated files.

The first line of a file is ``@`` and the column codes; lines that start with ``#`` and
empty lines are skipped; every other line is one observation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossierlake.dictionary import MULTI, SINGLE, AttrDictionary
from dossierlake.functions.times import parse_time
from dossierlake.operators.attributes import code_pairs, split_values
from dossierlake.schema import PROPS_TYPE

# Codes of the header fields.
HEADER_CODES = {
    "A010001": "entity_type",
    "A010002": "oid",
    "H010014": "capture_time",
    "B050016": "data_source",
    "H010001": "protocol",
    "H010003": "action",
}
TAG = "@"
COMMENT = "#"
DELIMITER = "\t"


@dataclass
class TsvScan:
    """``observations`` that parsed and ``quarantine`` rows (line, file, reason)."""

    observations: DataFrame
    quarantine: DataFrame


def read_layout(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Column codes of the files, which must agree.

    Looks at the tagged first line of every file. Pass the layout to ``scan_tagged``
    instead when it is known, to save this pass over the text.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        ).alias("place"),
    )
    firsts = lines.groupBy("file").agg(F.min_by("value", "place").alias("first"))
    headers = (
        firsts.groupBy(F.trim("first").alias("header"))
        .agg(F.min("file").alias("file"))
        .limit(2)
        .collect()
    )
    for row in headers:
        if not row["header"].startswith(TAG):
            raise ValueError(f"no column header in {row['file']}: {row['header']}")
    if not headers:
        raise ValueError(f"no lines in {paths}")
    if len(headers) > 1:
        files = ", ".join(row["file"] for row in headers)
        raise ValueError(f"column headers differ, scan these files apart: {files}")
    return parse_layout(headers[0]["header"])


def parse_layout(header: str) -> list[str]:
    return [code.strip() for code in header.strip()[len(TAG):].split(DELIMITER)]


def scan_tagged(
    spark: SparkSession,
    paths: str | list[str],
    dictionary: AttrDictionary,
    layout: list[str] | None = None,
    pad_short: bool = False,
) -> TsvScan:
    """Observations and rejected lines of tagged files.

    A line is rejected when its width differs from the header (extra empty cells are
    fine, and with ``pad_short`` missing ones too), when type, id or time is missing,
    or when the time does not parse, and so are all lines of a file whose first line is not
    the header. The arrival number is the line's position: files in order of their paths,
    lines in order of the file.
    """
    layout = layout or read_layout(spark, paths)
    text = numbered_lines(spark, paths)
    header_line = TAG + DELIMITER.join(layout)
    data = text.where(
        (F.col("value") != "")
        & ~F.col("value").startswith(COMMENT)
        & (F.trim("value") != header_line)
    )
    cells = data.select("*", F.split("value", DELIMITER, -1).alias("cells"))
    parsed = cells.select(
        "*", *_header_columns(layout), _props(layout, dictionary).alias("props")
    )
    other = F.trim("header") != header_line
    reason = F.when(other, "header differs").otherwise(_reason(len(layout), pad_short))
    checked = parsed.withColumn("reason", reason).withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(""))
            for name in ("data_source", "protocol", "action")
        }
    )
    good = checked.where(F.col("reason").isNull()).select(
        "entity_type", "oid", "data_source", "protocol", "action",
        "capture_time", "seq", "props",
    )
    bad = checked.where(F.col("reason").isNotNull()).select("value", "file", "reason")
    return TsvScan(good, bad)


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, the file's first line and their position over all files.

    A first pass counts the lines of every input split. That table has one row per split,
    which is what the driver plans the scan with anyway, so it is broadcast.
    """
    text = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    splits = text.groupBy("file", "block").agg(
        F.min("at").alias("first_at"),
        F.count(F.lit(1)).alias("n"),
        F.min_by("value", "at").alias("head"),
    )
    places = Window.orderBy("file", "block")
    splits = splits.select(
        "file",
        "block",
        "first_at",
        F.first("head").over(Window.partitionBy("file").orderBy("block")).alias("header"),
        (F.sum("n").over(places) - F.col("n")).alias("before"),
    )
    return text.join(F.broadcast(splits), ["file", "block"]).select(
        "value", "file", "header", (F.col("before") + F.col("at") - F.col("first_at")).alias("seq")
    )


def _cell(at: int) -> Column:
    """Cell by position; empty and missing cells are null."""
    return F.nullif(F.get("cells", F.lit(at)), F.lit(""))


def _header_columns(layout: list[str]) -> list[Column]:
    columns = []
    for code, name in HEADER_CODES.items():
        value = F.lit(None).cast("string")
        for at, column in enumerate(layout):
            if column == code:
                value = _cell(at)
        if name == "capture_time":
            columns.append(value.alias("time_text"))
            value = parse_time(value)
        columns.append(value.alias(name))
    return columns


def _props(layout: list[str], dictionary: AttrDictionary) -> Column:
    empty = F.array().cast(PROPS_TYPE)
    parts = []
    for at, code in enumerate(layout):
        kind = dictionary.kinds.get(code)
        if kind not in (SINGLE, MULTI):
            continue
        values = split_values(_cell(at)) if kind == MULTI else F.array(_cell(at))
        parts.append(
            F.when(_cell(at).isNotNull(), code_pairs(code, values)).otherwise(empty)
        )
    return F.concat(*parts) if parts else empty


def _reason(width: int, pad_short: bool) -> Column:
    surplus = F.slice(F.col("cells"), width + 1, F.greatest(F.size("cells"), F.lit(1)))
    reason = F.when(F.exists(surplus, lambda c: c != ""), "too many columns")
    if not pad_short:
        reason = reason.when(F.size("cells") < width, "too few columns")
    return (
        reason.when(F.col("entity_type").isNull(), "no entity type")
        .when(F.col("oid").isNull(), "no entity id")
        .when(F.col("time_text").isNull(), "no time")
        .when(F.col("capture_time").isNull(), "bad time")
    )


def count_records(scan: TsvScan) -> int:
    return scan.observations.count()


def write_tagged(wide: DataFrame, path: str, layout: list[str]) -> None:
    """Write wide rows (columns named by code) as tagged files, one header per file."""
    from dossierlake.operators.assemble import delimited

    write_lines(delimited(wide.na.fill(""), layout, DELIMITER), path, layout)


def write_lines(lines: DataFrame, path: str, layout: list[str]) -> None:
    """Write ready lines (column ``value``) as tagged files."""
    header = TAG + DELIMITER.join(layout)
    # A CSV writer with one column puts its name on top of every file.
    lines.select(F.col("value").alias(header)).write.mode("errorifexists").options(
        header="true", sep="\x01", quote="", escapeQuotes="false",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)
