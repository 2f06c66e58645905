"""Quality classifier with hierarchical empirical Bayes over sites.

One pass over the texts measures a few features. A logistic model, fit on a bounded sample of
labelled documents, turns them into evidence: the probability that a document is good. Evidence is
summed by host and by path in grouped aggregations, which cover every document. Each host's mean is
shrunk toward the global mean, each path's toward its host's, by prior strengths that are estimated
from how far hosts and paths really differ; a site with few documents stays near its prior. A
document's own evidence is left out of its path's mean, and the posterior is its evidence with that
mean in place of the sample's.

Null host or path: a site of its own, named by the empty string. Null or empty text: features 0,
scored like any other. Repeated rows: each is scored and counted. No labels of one of the classes:
the evidence is 0.5 for all. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import flat_bytes, prepared, slices
from dossierlake.llm.quality_rules import SLICE, repeat_words, row_sums
from dossierlake.llm.words import spans, word_hashes
from dossierlake.session import materialize

# Labelled documents that the model is fit on at most, chosen by a hash of their id.
SAMPLE = 20_000
RIDGE = 1.0
THRESHOLD = 0.5
# Bounds of the prior strengths, in documents.
STRENGTH = (2.0, 10_000.0)

FEATURES = (
    "upper", "digits", "marks", "exclaims", "marked_words", "repeated_words", "window_repeats",
    "short_words", "log_words", "word_length",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"#*$%&|<>@^~_={}[]\\/+")] = True


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    n = len(offsets) - 1
    starts, ends, rows = spans(data, offsets)
    size = np.maximum(np.diff(offsets), 1)
    words = np.maximum(np.bincount(rows, minlength=n), 1)
    hashes = word_hashes(data, starts, ends)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    odd = np.concatenate([[0], np.cumsum(_MARK[data] | (data == 33))])
    marked = odd[ends] > odd[starts]
    length = ends - starts
    out = [
        row_sums(_UPPER[data], offsets) / np.maximum(row_sums(_LETTER[data], offsets), 1),
        row_sums(_DIGIT[data], offsets) / size,
        row_sums(_MARK[data], offsets) / size,
        row_sums(data == 33, offsets) / size,
        np.bincount(rows[marked], minlength=n) / words,
        np.bincount(rows[again], minlength=n) / words,
        repeat_words(hashes, rows, n) / words,
        np.bincount(rows[length < 3], minlength=n) / words,
        np.log1p(np.bincount(rows, minlength=n)),
        np.log1p(np.bincount(rows, length, minlength=n) / words),
    ]
    return np.stack(out, 1)


def measure(docs: DataFrame, keys: list[Column]) -> DataFrame:
    """Key columns and the features of column ``text``."""
    named = docs.select(*keys, F.col("text").cast("string").cast("binary").alias("text"))
    names = named.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(len(names)))
            for a, b in slices(offsets, SLICE):
                part = data[offsets[a] : offsets[b]]
                found = features(part, offsets[a : b + 1] - offsets[a])
                columns = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(pa.array(f) for f in found.T)], [*names, *FEATURES]
                )

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields[:-1]]
    return named.mapInArrow(run, ", ".join([*kinds, *(f"{f} double" for f in FEATURES)]))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic model, on the features as they are."""
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1]), 0.0
    centre, spread = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], RIDGE)
    penalty[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty * w
        hess = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    inner = w[:-1] / spread
    return inner, float(w[-1] - centre @ inner)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(mean: float, spread: float, noise: float) -> float:
    """Prior documents by moments: spread of group means less what chance makes of it."""
    real = max(spread - noise, 1e-9)
    return float(np.clip(mean * (1 - mean) / real - 1, *STRENGTH))


def evidence(docs: DataFrame, labels: DataFrame, keys: dict[str, Column]) -> tuple[DataFrame, float]:
    """Keys with the log odds of the document model, and the share of good rows in its sample.

    ``keys`` names id, host and path; docs has a column ``text``.
    """
    prepared(docs.sparkSession)
    measured = materialize(measure(docs, [c.alias(n) for n, c in keys.items()]), "features")
    known = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("id"))
    known = known.agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    sample = measured.join(chosen, "id").select(*FEATURES, "quality").limit(2 * SAMPLE).toPandas()
    x, y = sample[list(FEATURES)].to_numpy(float), sample["quality"].to_numpy(float)
    weights, intercept = fit(x, y)
    score = F.lit(intercept)
    for name, weight in zip(FEATURES, weights, strict=True):
        score = score + F.col(name) * F.lit(float(weight))
    share = float(np.clip(y.mean(), 0.01, 0.99)) if weights.any() else 0.5
    return measured.select(*keys, score.alias("logit")), share


def posteriors(rows: DataFrame, share: float) -> DataFrame:
    """Adds evidence, host_posterior, path_posterior and score to id, host, path and logit."""
    rows = rows.withColumn("evidence", 1 / (1 + F.exp(-F.least(F.greatest("logit", F.lit(-30)), F.lit(30)))))
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum("evidence").alias("s_path"))
    paths = materialize(paths, "path-evidence")
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    hosts = materialize(hosts, "host-evidence")
    top = hosts.agg(F.sum("s_host"), F.sum("n_host")).first()
    mean = float(np.clip((top[0] or 0.0) / max(1, top[1] or 0), 1e-3, 1 - 1e-3)) if top[1] else 0.5
    weight = F.sum("n_host")
    apart = hosts.agg(
        F.sum(F.col("n_host") * F.pow(F.col("s_host") / F.col("n_host") - mean, 2)) / weight,
        F.count("*") / weight,
    ).first()
    k_host = _strength(mean, apart[0] or 0.0, mean * (1 - mean) * (apart[1] or 0.0))
    hosts = hosts.withColumn(
        "host_posterior", (F.lit(k_host * mean) + F.col("s_host")) / (F.lit(k_host) + F.col("n_host"))
    )
    sites = paths.join(hosts, "host")
    weight = F.sum("n_path")
    apart = sites.agg(
        F.sum(F.col("n_path") * F.pow(F.col("s_path") / F.col("n_path") - F.col("host_posterior"), 2)) / weight,
        F.count("*") / weight,
    ).first()
    k_path = _strength(mean, apart[0] or 0.0, mean * (1 - mean) * (apart[1] or 0.0))
    sites = materialize(sites.select("host", "path", "n_path", "s_path", "host_posterior"), "sites")
    # The site table was written, so the join's sides are plain shuffles that may be split where a
    # site holds very many documents.
    joined = rows.join(sites, ["host", "path"])
    others = (F.lit(k_path) * F.col("host_posterior") + F.col("s_path") - F.col("evidence")) / (
        F.lit(k_path) + F.col("n_path") - 1
    )
    odds = F.col("logit") + _logit(F.col("path_posterior")) - float(np.log(share / (1 - share)))
    return joined.withColumn("path_posterior", others).withColumn("score", 1 / (1 + F.exp(-odds)))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, score and kept, and ``extra`` columns.

    Host and path default to the columns source and lang.
    """
    blank = F.lit("")
    keys = {
        "id": F.col(id_col).cast("bigint"),
        "host": F.coalesce((F.col("source") if host is None else host).cast("string"), blank),
        "path": F.coalesce((F.col("lang") if path is None else path).cast("string"), blank),
        **(extra or {}),
    }
    named = docs.select(*(c.alias(f"_{n}") for n, c in keys.items()), F.col(text_col).alias("text"))
    rows, share = evidence(named, labels, {n: F.col(f"_{n}") for n in keys})
    scored = posteriors(rows, share)
    columns = ["evidence", "host_posterior", "path_posterior", "score"]
    return scored.select(
        F.col("id").alias("doc_id"), *(extra or {}), *columns, (F.col("score") >= THRESHOLD).alias("kept")
    )
