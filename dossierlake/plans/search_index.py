"""An inverted index of profiles: bitmaps of entity numbers per code, value, protocol and action.

    <root>/entities/batch=<id>   entity and its number; numbers are dense and never change
    <root>/postings/batch=<id>   posting key, chunk of 32,768 numbers, bitmap

A batch numbers the entities that are new and adds its own postings; bitmaps of one key and chunk are
joined by OR when they are read, so nothing stored is rewritten. A search reads the postings of its terms,
combines bitmaps chunk by chunk and fetches entities last, from the chunks that are left. A value that very
many entities hold is many small bitmaps, spread by chunk. A batch that was cut off is simply added again; one
that is complete is skipped. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.operators.numbering import numbered
from dossierlake.schema import ENTITY
from dossierlake.session import materialize

POSTING = ["code", "value", "protocol", "action"]
ENTITIES = f"{', '.join(f'{c} string' for c in ENTITY)}, number bigint, chunk bigint, batch string"
POSTINGS = f"{', '.join(f'{c} string' for c in POSTING)}, chunk bigint, bits binary, batch string"


@dataclass(frozen=True)
class Term:
    """An attribute to search for; without protocol or action any will do."""

    code: str
    value: str
    protocol: str | None = None
    action: str | None = None

    def fits(self) -> Column:
        given = [(c, v) for c, v in zip(POSTING, (self.code, self.value, self.protocol, self.action)) if v is not None]
        match = F.lit(True)
        for name, value in given:
            match = match & (F.col(name) == value)
        return match


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def entities(self) -> DataFrame:
        return self._read("entities", ENTITIES)

    def postings(self) -> DataFrame:
        return self._read("postings", POSTINGS)

    # -- updating ---------------------------------------------------------------------------

    def add(self, attrs: DataFrame, batch_id: str) -> bool:
        """Index the attribute rows of a batch; false if that was done before."""
        if not self.postings().where(F.col("batch") == batch_id).isEmpty():
            return False
        rows = materialize(attrs.select(*ENTITY, *POSTING).distinct(), "index-rows")
        others = self.entities().where(F.col("batch") != batch_id)
        fresh = rows.select(*ENTITY).distinct().join(others.select(*ENTITY), ENTITY, "left_anti")
        last = others.agg(F.max("number")).first()[0] or 0
        fresh = numbered(materialize(fresh, "new-entities"), [], ENTITY, "number")
        fresh = fresh.withColumn("number", F.col("number") + F.lit(last))
        fresh = fresh.withColumn("chunk", F.bitmap_bucket_number("number"))
        fresh.write.mode("overwrite").parquet(f"{self.root}/entities/batch={batch_id}")
        known = self.entities().select(*ENTITY, "number", "chunk")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        postings = rows.join(known, ENTITY).groupBy(*POSTING, "chunk").agg(bits)
        # Sorted, so that a search skips the row groups of other codes and values.
        sorted_ = postings.repartitionByRange("code", "value", "chunk").sortWithinPartitions(*POSTING)
        sorted_.write.mode("overwrite").parquet(f"{self.root}/postings/batch={batch_id}")
        return True

    # -- searching --------------------------------------------------------------------------

    def bitmaps(self, terms: Sequence[Term], mode: str = "and") -> DataFrame:
        """chunk and bits of the entities that hold all (``and``) or any (``or``) of the terms."""
        if mode not in ("and", "or"):
            raise ValueError(f"unknown mode: {mode}")
        any_term = terms[0].fits()
        for term in terms[1:]:
            any_term = any_term | term.fits()
        found = self.postings().where(any_term)
        if mode == "or":
            return found.groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
        # A posting may serve several terms.
        which = F.filter(
            F.array(*[F.when(t.fits(), F.lit(i)) for i, t in enumerate(terms)]), lambda i: i.isNotNull()
        )
        per_term = found.select("chunk", "bits", F.explode(which).alias("term"))
        per_term = per_term.groupBy("chunk", "term").agg(F.bitmap_or_agg("bits").alias("bits"))
        both = per_term.groupBy("chunk").agg(F.count("*").alias("terms"), F.bitmap_and_agg("bits").alias("bits"))
        return both.where(F.col("terms") == len(terms)).drop("terms")

    def search(self, terms: Sequence[Term], mode: str = "and") -> DataFrame:
        """Entities that hold all or any of the terms."""
        bits = self.bitmaps(terms, mode).where(F.bitmap_count("bits") > 0)
        place = F.bitmap_bit_position("number")
        byte = F.conv(F.hex(F.substr("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        on = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
        return self.entities().join(bits, "chunk").where(on).select(*ENTITY)

    def count(self, terms: Sequence[Term], mode: str = "and") -> DataFrame:
        """How many entities a search finds, from the bitmaps alone."""
        total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint")
        return self.bitmaps(terms, mode).agg(total.alias("entities"))
