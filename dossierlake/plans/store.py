"""Versioned snapshot store for profile tables.

A version is a list of Parquet segments per table, written once and never changed:

    <root>/data/<table>/segment=<id>/bucket=B/*.parquet
    <root>/log/*.parquet        one row per version: its segments and its batch id

Adding a batch writes only the batch and lists one more segment: the fold's measures
add up, so readers sum over segments. Deletes and compaction rewrite the buckets they
touch; older segments stay listed with those buckets skipped. A version becomes visible
when its log row is committed, so a failed job leaves nothing but an unlisted folder.
There is one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossierlake.functions.keys import bucket_of
from dossierlake.operators.attributes import SLOT

LOG_SCHEMA = (
    "version bigint, batch_id string, created timestamp, buckets int, "
    "segments array<struct<table:string, path:string, schema:string, skip:array<int>>>"
)
DEFAULT_BUCKETS = 16

CODECS = {"none": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd"}
DEFAULT_CODEC = "snappy"


def parquet_codec(name: str | None) -> str:
    """Codec of written tables: unknown names fall back to the default.

    ``lzo`` is refused because Spark does not bundle it. A class-like name such as
    ``SnappyCodec`` works too.
    """
    plain = (name or DEFAULT_CODEC).lower().removesuffix("codec")
    if plain == "lzo":
        raise ValueError("codec lzo is not available in Spark, use snappy, gzip or zstd")
    return CODECS.get(plain, DEFAULT_CODEC)


class SnapshotStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = DEFAULT_BUCKETS,
        codec: str = DEFAULT_CODEC,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.codec = parquet_codec(codec)
        try:
            head = self.head()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.createDataFrame([], LOG_SCHEMA).coalesce(1).write.parquet(f"{self.root}/log")
            head = None
        self.buckets = head["buckets"] if head else buckets

    # -- versions -----------------------------------------------------------------

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/log")

    def head(self) -> Row | None:
        return self._head_and_seen(None)[0]

    def _head_and_seen(self, batch_id: str | None) -> tuple[Row | None, bool]:
        """The newest version, and whether a batch id is listed, in one small job."""
        entry = F.struct("version", "batch_id", "created", "buckets", "segments")
        row = self.log().agg(
            F.max_by(entry, "version").alias("head"),
            F.max(F.col("batch_id") == F.lit(batch_id)).alias("seen"),
        ).first()
        return row["head"], bool(row["seen"])

    def at(self, version: int | None) -> Row | None:
        if version is None:
            return self.head()
        row = self.log().where(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"no version {version} in {self.root}")
        return row

    def has_batch(self, batch_id: str) -> bool:
        return not self.log().where(F.col("batch_id") == batch_id).isEmpty()

    def version_of(self, batch_id: str) -> int:
        """Version that a batch made."""
        row = self.log().where(F.col("batch_id") == batch_id).first()
        if row is None:
            raise ValueError(f"no batch {batch_id} in {self.root}")
        return row["version"]

    def history(self) -> DataFrame:
        return self.log().select(
            "version", "batch_id", "created", F.size("segments").alias("segments")
        )

    # -- reading ------------------------------------------------------------------

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """All segments of a table as one bag with the ``bucket`` column."""
        scans = [scan.drop("segment") for scan in self.scans(table, version)]
        return reduce(DataFrame.unionByName, scans) if scans else None

    def scans(self, table: str, version: int | None = None) -> list[DataFrame]:
        """The same rows with ``segment``, a frame for all segments that skip the same buckets."""
        row = self.at(version)
        segments = [s for s in (row["segments"] if row else []) if s["table"] == table]
        groups: dict[tuple, list] = {}
        for s in segments:
            groups.setdefault((s["schema"], tuple(sorted(s["skip"]))), []).append(s["path"])
        scans = []
        for (schema, skip), paths in groups.items():
            frame = self._scan(paths, schema, table)
            scans.append(frame.where(~F.col("bucket").isin(*skip)) if skip else frame)
        return scans

    def _scan(self, paths: list[str], schema: str, table: str) -> DataFrame:
        """One scan over the folders ``segment=<id>`` of a table."""
        struct = StructType.fromJson(json.loads(schema))
        return (
            self.spark.read.schema(struct)
            .option("basePath", f"{self.root}/data/{table}")
            .parquet(*[f"{self.root}/{path}" for path in paths])
        )

    def newest(self, table: str, version: int | None = None) -> DataFrame:
        """The segment of a table that was listed last."""
        listed = [s for s in self.at(version)["segments"] if s["table"] == table]
        return self._scan([listed[-1]["path"]], listed[-1]["schema"], table).drop("segment")

    def segment_count(self, table: str) -> int:
        head = self.head()
        return sum(s["table"] == table for s in head["segments"]) if head else 0

    # -- writing ------------------------------------------------------------------

    def append(self, tables: dict[str, DataFrame], batch_id: str) -> int:
        """Add one segment per table. A batch id that is already listed is skipped."""
        head, seen = self._head_and_seen(batch_id)
        if seen:
            return head["version"]
        kept = [s.asDict() for s in head["segments"]] if head else []
        return self._commit(head, kept + self._write_all(tables), batch_id)

    def rewrite(
        self, tables: dict[str, DataFrame], batch_id: str, touched: list[int] | None = None
    ) -> int:
        """Replace the content of some buckets (all of them by default) of the tables."""
        head = self.head()
        kept = []
        for s in head["segments"] if head else []:
            segment = s.asDict()
            if s["table"] in tables:
                if touched is None:
                    continue
                segment["skip"] = sorted({*s["skip"], *touched})
                if len(segment["skip"]) >= self.buckets:
                    continue
            kept.append(segment)
        return self._commit(head, kept + self._write_all(tables), batch_id)

    def compact(self, merges: dict[str, callable], batch_id: str) -> int:
        """Fold all segments of each table into one with its merge function."""
        tables = {}
        for table, merge in merges.items():
            rows = self.read(table)
            if rows is not None:
                tables[table] = merge(rows.drop("bucket"))
        return self.rewrite(tables, batch_id)

    def touched_buckets(self, keys: DataFrame) -> list[int]:
        """Buckets of the given entities; at most as many numbers as there are buckets."""
        bucket = bucket_of(F.col("entity_type"), F.col("oid"), self.buckets)
        return sorted(r[0] for r in keys.select(bucket).distinct().collect())

    def _write_all(self, tables: dict[str, DataFrame]) -> list[dict]:
        return [self._write(name, rows) for name, rows in tables.items()]

    def _write(self, table: str, rows: DataFrame) -> dict:
        path = f"data/{table}/segment={uuid.uuid4().hex}"
        keyed = rows.drop("bucket", SLOT).withColumn(
            "bucket", bucket_of(F.col("entity_type"), F.col("oid"), self.buckets)
        )
        # The rebalance brings a bucket together in few files; adaptive execution splits
        # a bucket that is too big for one task and merges small ones. Rows with a slot lie in
        # tasks of one bucket each and stay there. Files sorted by
        # id let a lookup skip row groups; more sort columns would only cost time. The ids'
        # Bloom filter, no larger than their number asks for, rules out the rest.
        (
            (keyed if SLOT in rows.columns else keyed.hint("rebalance", F.col("bucket")))
            .sortWithinPartitions("bucket", "oid")
            .write.partitionBy("bucket")
            .option("compression", self.codec)
            .option("parquet.bloom.filter.enabled#oid", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(f"{self.root}/{path}")
        )
        return {"table": table, "path": path, "schema": keyed.schema.json(), "skip": []}

    def _commit(self, head: Row | None, segments: list[dict], batch_id: str) -> int:
        version = head["version"] + 1 if head else 1
        entry = (
            version,
            batch_id,
            datetime.now(timezone.utc),
            self.buckets,
            [(s["table"], s["path"], s["schema"], list(s["skip"])) for s in segments],
        )
        self.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.root}/log")
        return version
