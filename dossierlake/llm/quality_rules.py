"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio.

Byte n-grams are hashed into a fixed number of bins. Two multinomials over the bins are counted, one
from trusted documents (quality label 1) and one from all documents; both counts cover every
document. A document's score is the mean log ratio of its n-grams, so its length does not matter.
Log ratios are whole numbers of 1/SCALE: sums are exact, and a document gets the same verdict
wherever and however often it is scored.

Scores are not comparable across languages and table sizes: a language's scores lie about the log of
its share of trusted text over its share of all text, and smoothing moves rare n-grams. So with a
language column, as in the registered query, each language has its own threshold, the LOW_PERCENT percentile of its trusted documents' scores, each
counted without the document's own n-grams among the trusted ones; -THRESHOLD / their number is taken
off for small numbers. A language without trusted documents is judged by the same percentile of all
trusted documents, which its texts reach only as far as their n-grams are those of trusted texts in
other languages. Calls without a language column compare with THRESHOLD.

Null or empty text: all counts 0, no n-grams, failed by the word rule. Text shorter than an n-gram:
score 0. Repeated rows: scored one by one; a document with several labels is trusted if any of them
is 1. No labels: both multinomials are smooth, the score is that against a uniform target, and the base
rule decides. Null language: a language of its own. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import flat_bytes, prepared, slices
from dossierlake.llm.words import SPACE, mix, spans, window_hashes, word_hashes

NGRAM = 4
BIN_BITS = 18
SMOOTH = 1.0
SCALE = 10_000
THRESHOLD = -0.20
LOW_PERCENT = 1
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SLICE = 1 << 20

# Fixed values of the rule: symbols that are counted.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, score double, kept boolean"
)


def bins(data: np.ndarray) -> np.ndarray:
    """Bin of the n-gram that begins at each byte; the last bytes begin none."""
    n = len(data) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    gram = data[:n].astype(np.uint32)
    for i in range(1, NGRAM):
        gram |= data[i : i + n].astype(np.uint32) << np.uint32(8 * i)
    gram *= np.uint32(0x9E3779B1)
    gram ^= gram >> np.uint32(15)
    gram *= np.uint32(0x85EBCA77)
    return gram >> np.uint32(32 - BIN_BITS)


def rows_of_bytes(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def whole_grams(offsets: np.ndarray) -> np.ndarray:
    """Starts of n-grams that do not cross into another row."""
    n = int(offsets[-1]) - NGRAM + 1
    whole = np.ones(max(0, n), bool)
    for i in range(1, NGRAM):
        at = offsets[1:-1] - i
        whole[at[(at >= 0) & (at < len(whole))]] = False
    return whole


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of whole numbers between offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[np.minimum(offsets[1:], len(values))] - total[np.minimum(offsets[:-1], len(values))]


def count_bins(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """bin, n-grams in trusted documents, n-grams in all documents."""
    trusted = _trusted(labels)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).join(trusted.withColumn("trusted", F.lit(True)).hint("merge"), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = np.zeros(1 << BIN_BITS, np.int64)
        corpus = np.zeros(1 << BIN_BITS, np.int64)
        for batch in batches:
            trust = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            data, offsets = flat_bytes(batch.column(0))
            for a, b in slices(offsets, SLICE):
                part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                whole = whole_grams(ends)
                found = bins(part)
                corpus += np.bincount(found[whole], minlength=1 << BIN_BITS)
                whole &= trust[a:b][rows_of_bytes(ends)][: len(whole)]
                target += np.bincount(found[whole], minlength=1 << BIN_BITS)
        used = np.flatnonzero(corpus)
        columns = [pa.array(x) for x in (used, target[used], corpus[used])]
        yield pa.RecordBatch.from_arrays(columns, ["bin", "target", "corpus"])

    counted = rows.select("text", "trusted").mapInArrow(count, "bin bigint, target bigint, corpus bigint")
    return counted.groupBy("bin").agg(F.sum("target").alias("target"), F.sum("corpus").alias("corpus"))


def multinomials(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smooth counts of every bin, trusted and all. The table has 1 << BIN_BITS rows at most."""
    target = np.full(1 << BIN_BITS, SMOOTH)
    corpus = np.full(1 << BIN_BITS, SMOOTH)
    found = counts.toPandas()
    target[found["bin"]] += found["target"]
    corpus[found["bin"]] += found["corpus"]
    return target, corpus


def log_ratios(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Log ratio of every bin in 1/SCALE."""
    ratio = np.log(target / target.sum()) - np.log(corpus / corpus.sum())
    return np.rint(ratio * SCALE).astype(np.int32)


def scores_without_own(
    data: np.ndarray, offsets: np.ndarray, target: np.ndarray, corpus: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Score of each row in 1/SCALE as if its n-grams were not among the trusted ones, and n-grams."""
    whole = whole_grams(offsets)
    grams = row_sums(whole, offsets)
    row = rows_of_bytes(offsets)[: len(whole)][whole]
    keys, times = np.unique(row << BIN_BITS | bins(data)[whole], return_counts=True)
    row, found = keys >> BIN_BITS, keys & (1 << BIN_BITS) - 1
    # Rows that are not trusted are scored as well; their scores are not used.
    left = np.maximum(target[found] - times, SMOOTH)
    size = np.maximum(target.sum() - grams, 1.0)
    ratio = np.log(left / size[row]) - np.log(corpus[found] / corpus.sum())
    total = np.zeros(len(grams), np.int64)
    np.add.at(total, row, np.rint(ratio * SCALE).astype(np.int64) * times)
    return total // np.maximum(grams, 1), grams


def thresholds(
    docs: DataFrame, labels: DataFrame, target: np.ndarray, corpus: np.ndarray,
    id_col: str, text_col: str, lang_col: str,
) -> tuple[dict[str | None, int], int]:
    """Least score in 1/SCALE of every language with trusted documents, and of the others."""
    shared = prepared(docs.sparkSession).sparkContext.broadcast((target, corpus))  # 2 << BIN_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(2))
            for a, b in slices(offsets, SLICE):
                part = data[offsets[a] : offsets[b]]
                score, grams = scores_without_own(part, offsets[a : b + 1] - offsets[a], *shared.value)
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)]
                columns += [pa.array(score), pa.array(grams)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "least", "grams"])

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").cast("binary"),
    )
    scored = rows.mapInArrow(run, "doc_id bigint, lang string, least bigint, grams bigint").where("grams > 0")
    scored = scored.join(_trusted(labels).hint("merge"), "doc_id", "left_semi")
    # Scores are whole numbers, so a percentile holds few distinct ones.
    low = F.percentile("least", F.lit(LOW_PERCENT / 100))
    found = scored.rollup("lang").agg(
        low.alias("low"), F.count("*").alias("n"), F.grouping("lang").alias("every")
    ).where("n > 0").collect()
    bounds = [(r["every"], r["lang"], int(np.floor(r["low"] + THRESHOLD * SCALE / r["n"]))) for r in found]
    # No score is as low as -100: without any trusted document there is nothing to compare with.
    others = next((bound for every, _, bound in bounds if every), -100 * SCALE)
    return {lang: bound for every, lang, bound in bounds if not every}, others


def _trusted(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("bigint")).distinct()


def repeat_words(words: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Words of each row that lie in a window found twice or more in the row."""
    keys, first = window_hashes(words, rows, REPEAT_WINDOW)
    if not len(keys):
        return np.zeros(n_rows, np.int64)
    keys ^= mix(rows[first].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = (keys[order][1:] == keys[order][:-1]) & (rows[first[order]][1:] == rows[first[order]][:-1])
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    begin = first[twice]
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + REPEAT_WINDOW, -1)
    inside = np.cumsum(edge)[:-1] > 0
    return np.bincount(rows[inside], minlength=n_rows)


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measure(
    data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray, least: np.ndarray | int = round(THRESHOLD * SCALE)
) -> dict[str, np.ndarray]:
    """Counts and n-gram score of some rows; ``least`` is what a row must score in 1/SCALE."""
    n_rows = len(offsets) - 1
    starts, ends, rows = spans(data, offsets)
    letters = ~SPACE[data] & ((data & 0xC0) != 0x80)
    whole = whole_grams(offsets)
    found = bins(data)
    scores = np.where(whole, ratios[found], 0)
    grams, total = row_sums(whole, offsets), row_sums(scores, offsets)
    lines = row_sums(data == 10, offsets)
    raw = data.tobytes()
    dups = np.zeros(n_rows, np.int64)
    for row in np.flatnonzero(lines):
        dups[row] = dup_lines(raw[offsets[row] : offsets[row + 1]])
    words = np.bincount(rows, minlength=n_rows)
    repeated = repeat_words(word_hashes(data, starts, ends), rows, n_rows)
    failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)
    good = total >= least * grams
    return {
        "n_words": words,
        "word_chars": row_sums(letters, offsets),
        "n_symbols": row_sums(_SYMBOL[data], offsets),
        "n_dup_lines": dups,
        "n_repeat_words": repeated,
        "base_failed": failed,
        "score": total / np.maximum(grams, 1) / SCALE,
        "kept": good & ~failed,
    }


def score_documents(
    docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str | None = None, least: tuple[dict[str | None, int], int] | None = None,
) -> DataFrame:
    # 1 << BIN_BITS numbers, and one for each language.
    shared = prepared(docs.sparkSession).sparkContext.broadcast((ratios, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bounds = shared.value
        for batch in batches:
            data, offsets = flat_bytes(batch.column(1))
            if bounds is None:
                bound = np.full(batch.num_rows, round(THRESHOLD * SCALE))
            else:
                by_lang, others = bounds
                bound = np.array([by_lang.get(x, others) for x in batch.column(2).to_pylist()], np.int64)
            for a, b in slices(offsets, SLICE):
                part = data[offsets[a] : offsets[b]]
                got = measure(part, offsets[a : b + 1] - offsets[a], table, bound[a:b])
                columns = [batch.column(0).slice(a, b - a), *map(pa.array, got.values())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *got])

    lang = F.lit(None) if lang_col is None else F.col(lang_col)
    rows = docs.select(
        F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"), lang.cast("string")
    )
    return rows.mapInArrow(run, RESULT)


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    prepared(docs.sparkSession)
    target, corpus = multinomials(count_bins(docs, labels, id_col, text_col))
    least = lang_col and thresholds(docs, labels, target, corpus, id_col, text_col, lang_col)
    return score_documents(docs, log_ratios(target, corpus), id_col, text_col, lang_col, least)
