"""Reading several glob patterns at once, where some may match nothing."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossierlake.operators.merge import union_inputs

log = logging.getLogger(__name__)


def read_if_exists(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """Parquet at a path or glob, None when nothing is there."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_globs(
    spark: SparkSession, patterns: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """Union of comma separated globs; a glob without a match is skipped with a warning."""
    found = []
    for pattern in filter(None, (p.strip() for p in patterns.split(","))):
        part = read_if_exists(spark, pattern, schema)
        if part is None:
            log.warning("no input at %s, skipped", pattern)
        else:
            found.append(part)
    return reduce(DataFrame.unionByName, found) if found else None


def read_merge_inputs(
    spark: SparkSession,
    new_patterns: str,
    store_patterns: str = "",
    schema: StructType | str | None = None,
) -> DataFrame:
    """New data and stored profiles in one bag, tagged by ``src``; either may be missing."""
    new = read_globs(spark, new_patterns, schema)
    stored = read_globs(spark, store_patterns, schema)
    if new is None and stored is None:
        raise FileNotFoundError(f"no input at {new_patterns} nor at {store_patterns}")
    if new is None:
        return stored.withColumn("src", F.lit("store"))
    if stored is None:
        return new.withColumn("src", F.lit("new"))
    return union_inputs(stored, new)
