"""WARC archives: one gzip member per record, written by Spark tasks and read back in sequence.

The reader inflates a file piece by piece, takes a record's block by its Content-Length and checks
block and payload digests; it holds no more than a record header and one piece. Of pages with equal
long payloads the one with the largest id is stored, the others become revisit records.

Archives get a name of their own for each attempt; the manifest, a table that Spark commits, says
which of them count.

Null html: empty payload. Null url: no Target-URI. A null page id is kept and never preferred.
Repeated rows: every row becomes a record; rows that share the largest id and the payload are all
stored. Empty table: no archives, no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import open_store, prepared
from dossierlake.session import materialize, work_dir

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 128 << 20
CHUNK = 1 << 20
LEVEL = 6

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # pages carry no time
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint"
)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def page_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def record(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member. A revisit record keeps the payload's head and digest, not its bytes."""
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    ) + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_uri(refers_to)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


class Members:
    """Bytes of one gzip member after the other."""

    def __init__(self, source):
        self.source, self.raw, self.ready = source, b"", b""
        self.inflate = None

    def next_member(self) -> bool:
        """Goes to the next member; False at the end of the file."""
        if not self.raw:
            self.raw = self.source.read(CHUNK)
        self.inflate, self.ready = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        """Inflates another piece; False at the end of the member."""
        while not self.inflate.eof:
            if not self.raw and not self.inflate.unconsumed_tail:
                self.raw = self.source.read(CHUNK)
                if not self.raw:
                    raise ValueError("an archive ends inside a record")
            piece = self.inflate.decompress(self.inflate.unconsumed_tail + self.raw, CHUNK)
            self.raw = self.inflate.unused_data
            if piece:
                self.ready += piece
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What comes before the mark, however long: a header holds a whole url."""
        seen = 0
        while (at := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                raise ValueError("a record has no end of header")
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError("a record is shorter than its Content-Length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            yield piece


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_archive(source, with_payload: bool = False) -> Iterator[dict]:
    """Records of an archive; ValueError where framing or a digest is wrong."""
    members = Members(source)
    while members.next_member():
        head = fields(members.until(b"\r\n\r\n"))
        size = int(head["content-length"])
        block_sha, payload_sha, http, kept = hashlib.sha1(), hashlib.sha1(), b"", []
        inside, stored = False, 0
        for piece in members.take(size):
            block_sha.update(piece)
            if not inside:
                http += piece
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                http, piece, inside = http[:at], http[at + 4 :], True
            payload_sha.update(piece)
            stored += len(piece)
            if with_payload:
                kept.append(piece)
        if b"".join(members.take(4)) != b"\r\n\r\n" or members.ready or members.more():
            raise ValueError("a record is longer than its Content-Length")
        revisit = head["warc-type"] == "revisit"
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        length = int(fields(http)["content-length"])
        if f"sha1:{block_sha.hexdigest()}" != head["warc-block-digest"]:
            raise ValueError(f"{head['warc-record-id']}: the block's digest differs")
        if not revisit and (payload_sha.hexdigest() != digest or stored != length):
            raise ValueError(f"{head['warc-record-id']}: the payload's digest differs")
        yield {
            "page_id": page_of(head["warc-record-id"]),
            "payload_bytes": length,
            "payload_digest": digest,
            "record_type": head["warc-type"],
            "refers_to": page_of(head["warc-refers-to"]) if revisit else None,
        } | ({"payload": None if revisit else b"".join(kept)} if with_payload else {})


def revisits(pages: DataFrame) -> DataFrame:
    """Pages whose payload another page stores: page, digest, and that page.

    ``pages`` has page_id, html (bytes). Counts and largest ids per payload are aggregated before
    the join and written, so adaptive execution may split a payload that very many pages share.
    """
    light = pages.select("page_id", F.sha1("html").alias("digest"), F.length("html").alias("size"))
    light = materialize(light.where(F.col("size") >= REVISIT_BYTES), "payloads")
    shared = light.groupBy("digest").agg(F.max("page_id").alias("stored"), F.count("*").alias("n"))
    shared = materialize(shared.where("n > 1 AND stored IS NOT NULL").drop("n"), "shared-payloads")
    found = light.join(shared, "digest").where("NOT (page_id <=> stored)")
    return found.select("page_id", "digest", "stored").distinct()


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Writes the archives and returns their committed manifest: file, records."""
    prepared(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"),
    )
    again = revisits(rows).withColumnRenamed("page_id", "again_id").withColumnRenamed("digest", "again")
    rows = rows.withColumn("digest", F.sha1("html"))
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again"))
    rows = rows.join(again, same, "left").select(
        "page_id", "url", "html", "digest", "stored", F.col("again").isNotNull().alias("revisit")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        out, name, count, size = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                member = record(*row)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((name, count))
        if out is not None:
            out.close()
            done.append((name, count))
        if done:
            columns = [pa.array(c) for c in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "records"])

    return materialize(rows.mapInArrow(write, "file string, records bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Verified records of all archives of a manifest, without payloads."""
    spark = prepared(manifest.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for name, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_stream(f"{path}/{name}", compression=None) as source:
                    rows, seen = [], 0
                    for row in read_archive(source):
                        rows.append(row)
                        seen += 1
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                if seen != count:
                    raise ValueError(f"{name} has {seen} records, not {count}")

    return manifest.repartition(parts, "file").mapInArrow(read, RECORDS)


_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    folder = work_dir(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **options), folder)
