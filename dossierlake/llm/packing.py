"""Packing by power-of-two decomposition.

A document of n ids is cut into the binary digits of n: as many pieces of the longest length as it
holds, then one piece for each digit of the rest, longest first. Pieces of one length form a
bucket, and each piece is a sequence of its own: every sequence is a power of two, so none is
padded and none crosses documents. A batch takes sequences of one bucket.

Null text: a document of only the end id. Rows with equal ids are packed one by one; a null id is
kept. Empty table: no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import prepared
from dossierlake.llm.tokens import encoder
from dossierlake.session import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LONGEST = 4096

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n ids; longest is a power of two."""
    rest = n % longest
    digits = [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * (n // longest) + digits


def cut_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    longest: int = LONGEST,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece; with_ids adds its ids."""
    prepared(docs.sparkSession)
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    end = np.uint32(end_id).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids, at = ids + end, 0
                total = len(ids) // 4
                for n in piece_lengths(total, longest):
                    piece = ids[4 * at : 4 * (at + n)]
                    row = (doc, at, n, zlib.crc32(piece), total)
                    rows.append(row + (np.frombuffer(piece, np.int32),) * with_ids)
                    at += n
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def number_sequences(pieces: DataFrame) -> DataFrame:
    """Adds sequence_id, dense from 0 by bucket (longest first), document and start, and offset.

    Pieces are written as they are cut, so that sampling for the range partitioning does not cut
    them again, then range-partitioned in that order and written; the parts' row counts, one number
    per partition, give each part its first id.
    """
    pieces = materialize(pieces, "cut")
    order = [F.desc("length"), F.asc_nulls_first("doc_id"), F.asc("start"), F.asc("ids_crc32")]
    parts = pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = pieces.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    placed = placed.withColumn("_row", F.monotonically_increasing_id())
    placed = materialize(placed, "pieces")
    part = F.shiftright("_row", 33)
    counts = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    firsts, total = [], 0
    for row in counts:
        firsts.append((row["_part"], total - (row["_part"] << 33)))
        total += row["count"]
    # One row per shuffle partition, hence small enough to broadcast.
    first = pieces.sparkSession.createDataFrame(firsts, "_part bigint, _first bigint")
    numbered = placed.withColumn("_part", part.cast("bigint")).join(F.broadcast(first), "_part")
    return numbered.withColumns(
        {"sequence_id": F.col("_row") + F.col("_first"), "offset": F.lit(0).cast("bigint")}
    ).drop("_row", "_part", "_first")


def pack(docs: DataFrame, **options) -> DataFrame:
    return number_sequences(cut_documents(docs, **options))
