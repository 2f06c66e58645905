"""Bounded synthetic observations.

Every choice is a slice of a digest of (seed, id), so the same seed gives the same rows
in any partitioning, and each entity draws its values from a bounded set.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.functions.values import digest_slice
from dossierlake.operators.accumulate import throughput

DAY_SECONDS = 86400

# The value lists of generated observations.
SINGLE_CODES = "B010011,B010012,B010013,B010014,B010015,B010026,B010027".split(",")
MULTI_CODES = "B022001,B022002,B022003".split(",")
SINGLE_SUFFIXES = "H,I,J,K,L".split(",")
MULTI_SUFFIXES = "h,i,j,k,l,m,n,o,p,q".split(",")
TYPES = "qq.com,baidu.com,taobao.com,163.com,sina.com".split(",")
DATA_SOURCES = "116,120".split(",")
PROTOCOLS = "1030001,1030002".split(",")
ACTIONS = "16,19".split(",")
ID_START = 123456
ID_NUM = 25_000_000


@dataclass
class GeneratorConfig:
    day_start: int
    seed: str = "0"
    id_start: int = ID_START
    id_num: int = ID_NUM
    types: list[str] = field(default_factory=lambda: list(TYPES))
    data_sources: list[str] = field(default_factory=lambda: list(DATA_SOURCES))
    protocols: list[str] = field(default_factory=lambda: list(PROTOCOLS))
    actions: list[str] = field(default_factory=lambda: list(ACTIONS))
    single_codes: list[str] = field(default_factory=lambda: list(SINGLE_CODES))
    multi_codes: list[str] = field(default_factory=lambda: list(MULTI_CODES))
    single_suffixes: list[str] = field(default_factory=lambda: list(SINGLE_SUFFIXES))
    multi_suffixes: list[str] = field(default_factory=lambda: list(MULTI_SUFFIXES))


def _pick(digest: Column, start: int, digits: int, options: list[str]) -> Column:
    at = F.pmod(digest_slice(digest, start, digits), F.lit(len(options)))
    return F.element_at(F.array(*[F.lit(o) for o in options]), at.cast("int") + 1)


def generate(ids: DataFrame, config: GeneratorConfig, id_column: str = "id") -> DataFrame:
    """Observations for a batch or stream of ids; one output row per input row."""
    key = F.col(id_column).cast("string")
    drawn = ids.select(
        F.col(id_column).cast("bigint").alias("seq"),
        F.md5(F.concat_ws("|", F.lit(config.seed), key)).alias("h"),
        F.md5(F.concat_ws("|", F.lit(config.seed), key, F.lit("v"))).alias("v"),
    )
    h = F.col("h")
    header = drawn.select(
        _pick(h, 8, 4, config.types).alias("entity_type"),
        (F.lit(config.id_start) + F.pmod(digest_slice(h, 0, 8), F.lit(config.id_num)))
        .cast("string")
        .alias("oid"),
        _pick(h, 12, 2, config.data_sources).alias("data_source"),
        _pick(h, 14, 2, config.protocols).alias("protocol"),
        _pick(h, 16, 2, config.actions).alias("action"),
        (F.lit(config.day_start) + F.pmod(digest_slice(h, 18, 7), F.lit(DAY_SECONDS)))
        .cast("bigint")
        .alias("capture_time"),
        "seq",
        "v",
    )
    attrs = []
    codes = [(c, config.single_suffixes) for c in config.single_codes]
    codes += [(c, config.multi_suffixes) for c in config.multi_codes]
    for at, (code, suffixes) in enumerate(codes):
        stem = F.md5(F.concat("entity_type", "oid", F.lit(code)))
        # Three digits per draw; a digest of 32 digits serves ten codes.
        digest = F.col("v") if at < 10 else F.md5(F.concat("v", F.lit(str(at // 10))))
        suffix = _pick(digest, 3 * (at % 10), 3, suffixes)
        attrs.append(
            F.struct(F.lit(code).alias("code"), F.concat(stem, suffix).alias("value"))
        )
    return header.withColumn("props", F.array(*attrs)).drop("v")


def generate_range(
    spark: SparkSession, files: int, records_per_file: int, config: GeneratorConfig
) -> DataFrame:
    return generate(spark.range(0, files * records_per_file, 1, files), config)


def write_generated(
    observations: DataFrame, path: str, codec: str = "snappy"
) -> DataFrame:
    """Write generated observations, one file per task, and return the run summary.

    An existing output is refused. The time of a file is from the start of the job to
    the moment the file was closed.
    """
    from dossierlake.plans.store import parquet_codec

    spark = observations.sparkSession
    started = time.time()
    observations.write.mode("errorifexists").option(
        "compression", parquet_codec(codec)
    ).parquet(path)
    wall = max(1, int((time.time() - started) * 1000))
    return throughput(file_stats(spark, path, started), wall)


def file_stats(spark: SparkSession, path: str, started: float) -> DataFrame:
    """Records, bytes and milliseconds of every written file."""
    return (
        spark.read.parquet(path)
        .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_path")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.max("file_size").alias("bytes"),
            F.greatest(
                F.max(F.unix_millis("file_modification_time")) - F.lit(int(started * 1000)),
                F.lit(1),
            ).alias("millis"),
        )
    )
