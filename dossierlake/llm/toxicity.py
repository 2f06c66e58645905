"""Toxicity of whole texts by the recurrent network of ``gru``.

Every text is cut into overlapping windows of words, all of them are scored, and the text's score is
that of its worst window. Labels say only whether a text is toxic, not where: training turns by turn
finds each toxic text's worst window and each clean text's worst ones under the network so far, and
learns from those. The first turn goes by the log odds of words and n-grams in toxic texts, which
also begin one dimension of both embeddings. Training uses a bounded sample of labelled texts, and
none that is held out.

Null or empty text, and a text without letters and digits: score 0. Repeated rows and a null id are
scored as they come; a null id is not held out. Fewer than two labelled classes: every score is 0.
A document with several labels is toxic if one of them says so. The threshold applies to the network's
own probability, whatever the number of toxic examples. Empty table: no rows. Other columns
are kept by ``with_scores`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dossierlake.llm.frames import flat_bytes, prepared, slices
from dossierlake.llm.gru import Adam, Batch, Network

# Labelled texts of each class that training uses at most, chosen by a hash of their id among those
# of up to so many characters.
SAMPLE = 1000
SAMPLE_CHARS = 16_000
EPOCHS = 14  # a small sample takes more, toward so many updates
UPDATES, MOST_EPOCHS = 250, 40
AT_ONCE = 64
RATE = 0.01
THRESHOLD = 0.3
HELD_OUT, FOLDS = 2, 4
SLICE = 1 << 20


def fold(doc_id):
    """crc32 of the id as text, modulo FOLDS."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str):
    """Texts and labels of the bounded sample, in order of id."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(fold(F.col("id")) != HELD_OUT)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    short = texts.where(F.length("text") <= SAMPLE_CHARS).select("id").distinct()
    known = known.join(short, "id")
    order = [F.xxhash64("id"), "id"]
    chosen = [known.where(F.col("toxic") == v).orderBy(*order).limit(SAMPLE) for v in (0, 1)]
    # Twice SAMPLE rows at most, hence small enough to broadcast.
    sample = chosen[0].unionByName(chosen[1])
    found = texts.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(sample), "id")
    rows = found.orderBy("id", "text").limit(4 * SAMPLE).collect()
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.float32)


def begin(net: Network, batch: Batch, toxic: np.ndarray) -> np.ndarray:
    """Sets the first dimension of the embeddings, and returns a first score of every window."""
    n = len(batch.bins)
    pairs = np.unique(batch.rows * n + batch.place)  # a word counts once for each text
    word, hit = pairs % n, toxic[pairs // n]
    counts = np.diff(np.append(batch.gram_starts, len(batch.grams)))
    owner = np.repeat(np.arange(n), counts)
    seen = [np.bincount(word[hit == v], minlength=n).astype(float) for v in (True, False)]

    def odds(bins: np.ndarray, size: int, of: np.ndarray) -> np.ndarray:
        yes, no = (np.bincount(bins, x[of], minlength=size) for x in seen)
        level = yes.sum() / max(1.0, no.sum())
        return np.log(yes + 2 * level + 0.1) - np.log(level * (no + 2) + 0.1)

    by_word = odds(batch.bins, len(net.p["word"]), np.arange(n))
    by_gram = odds(batch.grams, len(net.p["gram"]), owner)
    net.p["word"][:, 0] = by_word / 2
    net.p["gram"][:, 0] = by_gram / 2
    of_word = by_word[batch.bins] + np.add.reduceat(by_gram[batch.grams], batch.gram_starts) / counts
    at = batch.windows
    return np.where(at >= 0, of_word[batch.place[at]], -np.inf).max(1)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Network | None:
    """Learns from the worst windows of every text; None if a class is missing."""
    if not len(labels) or labels.min() == labels.max():
        return None
    raw = [t.encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    batch = Batch(np.frombuffer(b"".join(raw), np.uint8), ends)
    if not len(batch.windows):
        return None
    net, random = Network(seed), np.random.default_rng(seed)
    adam = Adam(net.p, RATE)
    toxic = labels[batch.window_rows] > 0.5
    score = begin(net, batch, labels > 0.5)
    first = np.searchsorted(batch.window_rows, np.arange(batch.n_rows + 1))
    per_epoch = (int((labels > 0.5).sum()) + 2 * int((labels < 0.5).sum())) / AT_ONCE
    epochs = max(EPOCHS, min(MOST_EPOCHS, round(UPDATES / max(1.0, per_epoch))))
    for epoch in range(epochs):
        if epoch:
            score = net.logits(batch)
        # Windows by text, worst first.
        order = np.lexsort((-score, batch.window_rows))
        rank = np.arange(len(order)) - first[batch.window_rows[order]]
        chosen = order[rank < np.where(toxic[order], 1, 3)]
        random.shuffle(chosen)
        for a in range(0, len(chosen), AT_ONCE):
            some = chosen[a : a + AT_ONCE]
            adam.rate = RATE * (1 - epoch / epochs)
            adam.update(net.p, net.gradients(batch.part(some), toxic[some].astype(np.float32)))
    return net


def scores(net: Network | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of every text."""
    out = np.zeros(len(offsets) - 1)
    if net is None:
        return out
    batch = Batch(data, offsets)
    np.maximum.at(out, batch.window_rows, 1 / (1 + np.exp(-net.logits(batch).astype(float))))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    prepared(docs.sparkSession)
    return train(*training_sample(docs, labels, id_col, text_col))


def with_scores(docs: DataFrame, net: Network | None, text_col: str, name: str) -> DataFrame:
    """All columns, and the score of each row."""
    shared = prepared(docs.sparkSession).sparkContext.broadcast(net)  # of a fixed size
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(place)
            data, offsets = flat_bytes(column.cast(pa.large_string()).cast(pa.large_binary()))
            found = [
                scores(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for a, b in slices(offsets, SLICE)
            ]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    kinds = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, kinds)


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    net = fit(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_scores(rows, net, "text", "score").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
