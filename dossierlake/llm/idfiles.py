"""Files of token ids in document order, and their reading.

A file holds the documents of one range partition by id: blocks of coded ids (``idcoder``), each
behind a table of the documents, or parts of documents, that it holds. Files are written to the
shared folder under a name of their own for each attempt; the manifest, a table that Spark commits,
says which of them count, so lost executors and repeated tasks leave nothing wrong behind.

Null text: a document of only the end id. Rows with equal ids follow one another, ordered by text;
a null id comes first. Empty table: no files, no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossierlake.llm.frames import open_store, prepared
from dossierlake.llm.idcoder import decode_block, encode_block
from dossierlake.llm.tokens import encoder
from dossierlake.session import materialize, work_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
VOCABULARY = 50257
BLOCK_IDS = 1 << 22
BLOCK = struct.Struct("<II")  # bytes of the document table, bytes of the block
PART = np.dtype([("doc", "<i8"), ("null", "u1"), ("ids", "<u4"), ("last", "u1")])

MANIFEST = "file string, part bigint, docs bigint, ids bigint"
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class BlockWriter:
    """Collects documents and writes a block whenever enough ids are there."""

    def __init__(self, out, vocabulary: int):
        self.out, self.vocabulary = out, vocabulary
        self.parts: list[tuple] = []
        self.ids: list[bytes] = []
        self.held = 0

    def add(self, doc: int | None, ids: bytes) -> None:
        at, total = 0, len(ids) // 4
        while at < total:
            n = min(total - at, BLOCK_IDS - self.held)
            self.parts.append((doc or 0, doc is None, n, at + n == total))
            self.ids.append(ids[4 * at : 4 * (at + n)])
            self.held += n
            at += n
            if self.held == BLOCK_IDS:
                self.flush()

    def flush(self) -> None:
        if self.held:
            table = zlib.compress(np.array(self.parts, PART).tobytes(), 6)
            block = encode_block(np.frombuffer(b"".join(self.ids), "<u4"), self.vocabulary)
            self.out.write(BLOCK.pack(len(table), len(block)) + table + block)
        self.parts, self.ids, self.held = [], [], 0


def read_blocks(source) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Document table and ids of every block of a file."""
    while head := source.read(BLOCK.size):
        table, block = BLOCK.unpack(head)
        parts = np.frombuffer(zlib.decompress(source.read(table)), PART)
        ids = decode_block(source.read(block))
        if int(parts["ids"].sum()) != len(ids):
            raise ValueError("a block does not hold the ids of its documents")
        yield parts, ids


def write_id_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    vocabulary: int = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Writes the files in document order and returns the committed manifest."""
    spark = prepared(docs.sparkSession)
    end = np.uint32(end_id).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer).encode
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        part, name = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.ids"
        docs_in = ids_in = 0
        with store.open_output_stream(f"{path}/{name}") as out:
            writer = BlockWriter(out, vocabulary)
            for batch in batches:
                ids_of = encode(batch.column(1).to_pylist())
                for doc, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                    writer.add(doc, ids + end)
                    docs_in += 1
                    ids_in += len(ids) // 4 + 1
            writer.flush()
        if docs_in:
            row = [[name], [part], [docs_in], [ids_in]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["file", "part", "docs", "ids"])

    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
    return materialize(rows.mapInArrow(write, MANIFEST), "id-manifest")


def read_id_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document: ids of all documents before it, number of its ids and their crc32.

    The manifest has a row per file; its running sum gives each file its first position.
    """
    spark = prepared(manifest.sparkSession)
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("first", F.coalesce(before, F.lit(0))).select("file", "first")
    files = materialize(files, "id-files").repartition(
        max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = crc = 0
                with store.open_input_stream(f"{path}/{name}") as source:
                    for parts, ids in read_blocks(source):
                        raw, at, rows = memoryview(ids.astype("<u4").tobytes()), 0, []
                        for doc, null, n, last in parts.tolist():
                            crc = zlib.crc32(raw[4 * at : 4 * (at + n)], crc)
                            at += n
                            size += n
                            if last:
                                rows.append((None if null else doc, start, size, crc))
                                start += size
                                size = crc = 0
                        columns = list(zip(*rows, strict=True)) or [()] * 4
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in columns],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                if size:
                    raise ValueError(f"{name} ends inside a document")

    return files.mapInArrow(read, RESULT)


def id_file_round_trip(docs: DataFrame, **options) -> DataFrame:
    folder = work_dir(docs.sparkSession, "id-files")
    return read_id_files(write_id_files(docs, folder, **options), folder)
