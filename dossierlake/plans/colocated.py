"""Base profiles in bucketed tables, merged with new data without a shuffle of what is stored.

Two tables are bucketed alike, by row key and page: ``base`` with the profiles, and ``keys`` with each
row key once a page. The new data is dealt out to the same buckets, so each task joins one bucket of the
store with its share of the batch and writes one bucket of the result. A page follows from code and
value (``page_of``); with several pages the profile of a busy row key lies in as many buckets.

A merge writes a new pair of tables and leaves the old one as it is. Whoever calls it keeps the path of
the current pair; a merge that fails leaves nothing but an unfinished folder. Key columns are never null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.operators.merge import NEW, UNCHANGED, UPDATE
from dossierlake.operators.parts import page_of
from dossierlake.schema import ATTR_KEY, ROW_KEY

BUCKET_KEY = [*ROW_KEY, "page"]
BASE_KEY = [*ATTR_KEY, "page"]
KEYS = {**dict.fromkeys(ROW_KEY, "string"), "page": "int"}
BASE = {
    **dict.fromkeys(ATTR_KEY, "string"), "page": "int", "cnt": "bigint", "first_time": "bigint",
    "last_time": "bigint", "day_cnt": "int", "days": "map<int,bigint>", "status": "string",
}
SCHEMAS = {"base": BASE, "keys": KEYS}
# A bucket of the row key also brings rows together that agree in more columns than that.
SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


# Day rows that a bucket of a new table is made for.
BUCKET_ROWS = 250_000


def buckets_for(rows: int, least: int) -> int:
    """Buckets of a table for so many day rows, so that a task's share does not grow with the table."""
    return max(least, -(-rows // BUCKET_ROWS))


@contextmanager
def joins_within_buckets(spark: SparkSession) -> Iterator[None]:
    """Lets joins on a longer key use the buckets; the join must be planned inside."""
    before = spark.conf.get(SUBSET_KEYS)
    spark.conf.set(SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(SUBSET_KEYS, before)


@dataclass(frozen=True)
class BucketedProfiles:
    spark: SparkSession
    path: str
    buckets: int
    pages: int = 1

    def _name(self, table: str) -> str:
        digest = hashlib.md5(f"{self.path}:{self.buckets}".encode()).hexdigest()
        return f"{table}_{digest}"

    def read(self, table: str) -> DataFrame:
        """The bucketed table; a session that does not know it yet declares it by its folder."""
        if not self.spark.catalog.tableExists(self._name(table)):
            key = ", ".join(BUCKET_KEY)
            columns = ", ".join(f"{name} {kind}" for name, kind in SCHEMAS[table].items())
            self.spark.sql(
                f"CREATE TABLE {self._name(table)} ({columns}) USING parquet CLUSTERED BY ({key}) "
                f"SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}'"
            )
        return self.spark.table(self._name(table))

    def _write(self, table: str, rows: DataFrame) -> None:
        writer = rows.write.bucketBy(self.buckets, *BUCKET_KEY).sortBy(*BUCKET_KEY)
        writer.option("path", f"{self.path}/{table}").saveAsTable(self._name(table))

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *BUCKET_KEY)

    # -- building and merging -------------------------------------------------------------

    def build(self, base: DataFrame) -> BucketedProfiles:
        """Writes the tables of a first base profile."""
        paged = self.paged(base).withColumn("status", F.lit(NEW))
        self._write("base", self.dealt(_in_schema(paged)))
        self._write("keys", self.dealt(self.all_pages(base)))
        return self

    def merge(self, new: DataFrame, path: str) -> BucketedProfiles:
        """Tables at ``path`` that hold these and a new base profile, with the status of each row key."""
        out = BucketedProfiles(self.spark, path, self.buckets, self.pages)
        with joins_within_buckets(self.spark):
            out._write("base", self.merged(new))
            out._write("keys", self.merged_keys(new))
        return out

    def paged(self, base: DataFrame) -> DataFrame:
        return base.withColumn("page", page_of(self.pages, "code", "value"))

    def all_pages(self, base: DataFrame) -> DataFrame:
        """Each row key of the profile, once for each page."""
        pages = F.explode(F.sequence(F.lit(0), F.lit(self.pages - 1)))
        return base.select(*ROW_KEY).distinct().withColumn("page", pages)

    def merged_keys(self, new: DataFrame) -> DataFrame:
        touched = self.dealt(self.all_pages(new))
        return self.read("keys").join(touched.hint("merge"), BUCKET_KEY, "full")

    def merged(self, new: DataFrame) -> DataFrame:
        """Stored and new profiles; plan and run it inside ``joins_within_buckets``."""
        stored = self.read("base").drop("status")
        known = self.read("keys").withColumn("known", F.lit(True))
        touched = self.dealt(self.all_pages(new)).join(known.hint("merge"), BUCKET_KEY, "left")
        status = F.when(F.col("known"), UPDATE).otherwise(NEW)
        touched = touched.select(*BUCKET_KEY, status.alias("status"))
        old = stored.join(touched.select(*BUCKET_KEY, F.lit(UPDATE).alias("seen")).hint("merge"), BUCKET_KEY, "left")
        arrived = self.dealt(self.paged(new)).join(touched.hint("merge"), BUCKET_KEY)
        s, n = old.alias("s"), arrived.alias("n").hint("merge")
        same = F.col("s.page") == F.col("n.page")
        for name in ATTR_KEY:
            same = same & (F.col(f"s.{name}") == F.col(f"n.{name}"))
        days = F.when(F.col("s.days").isNull(), F.col("n.days")).when(F.col("n.days").isNull(), F.col("s.days"))
        days = days.otherwise(F.map_zip_with("s.days", "n.days", lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))))
        rows = s.join(n, same, "full").select(
            *[F.coalesce(f"s.{c}", f"n.{c}").alias(c) for c in BASE_KEY],
            (F.coalesce("s.cnt", F.lit(0)) + F.coalesce("n.cnt", F.lit(0))).alias("cnt"),
            F.least("s.first_time", "n.first_time").alias("first_time"),
            F.greatest("s.last_time", "n.last_time").alias("last_time"),
            days.alias("days"),
            F.coalesce("n.status", "s.seen", F.lit(UNCHANGED)).alias("status"),
        )
        return _in_schema(rows.withColumn("day_cnt", F.size("days")))


def _in_schema(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(name).cast(kind) for name, kind in BASE.items()])
