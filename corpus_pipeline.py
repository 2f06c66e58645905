"""A training-data pipeline: documents without toxic and poor ones and near copies, packed.

Stages run in order; each is written as Parquet and read again as the next one's input. All but the
last return the columns of documents. A stage works on all rows that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.llm import near_dup, packing, quality_bayes, toxicity
from dossierlake.llm.frames import free_names, table
from dossierlake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = free_names(docs, "toxicity")
    scored = toxicity.with_scores(docs, net, "text", score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    A row's decision is found again by its id and the digest of its text.
    """
    digest = near_dup.text_digest(F.col("text"))
    judged = quality_bayes.classify(docs, table(spark, sf_dir, "labels"), extra={"digest": digest})
    kept = judged.where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    kept = materialize(kept.distinct(), "kept")
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & digest.eqNullSafe(kept["_digest"])
    return docs.join(kept.hint("merge"), same, "left_semi")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the smallest id.

    Rows without an id or a text are no copies and stay. Of repeated rows one stays.
    """
    digest = near_dup.text_digest(F.col("text"))
    rows = docs.select(F.col("doc_id").alias("doc"), digest.alias("digest"), "text")
    classes = near_dup.classes(rows).where("doc = class AND digest IS NOT NULL")
    # Should the smallest id have several texts, the smallest digest stays.
    kept = classes.groupBy(F.col("doc").alias("_id")).agg(F.min("digest").alias("_digest"))
    kept = materialize(kept, "kept")
    (own,) = free_names(docs, "digest")
    named = docs.withColumn(own, digest)
    same = (named["doc_id"] == kept["_id"]) & (named[own] == kept["_digest"])
    # The join has brought repeated rows together.
    chosen = named.join(kept.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", own])
    return chosen.drop(own).unionByName(docs.where("doc_id IS NULL OR text IS NULL"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("packing", pack),
]

# The stages' models are no SQL; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
