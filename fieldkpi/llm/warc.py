"""WARC archives of web pages, with copies resolved to revisit records.

Three steps, each on files in the shared folder:

1. :func:`write_archives` writes a response record per page.
2. :func:`deduplicate` reads the archives' headers only, shuffles them by payload
   digest and finds each digest's original, the record with the smallest page id
   (ties: first file, first place in it). Headers of the other records come back
   by (file, place), and the archives are written again: originals whole, copies as
   revisit records with fresh headers that refer to their original.
3. :func:`read_archives` reads any archive of these.

Payloads never move by digest. They stay in their task if the list of copies is
small enough to broadcast, and otherwise move by (file, place), which no page
shares, so a payload that a third of all pages hold burdens no task.

A record is its head, an empty line and a block; the block is an HTTP head, an
empty line and the payload. Lengths are in bytes, and the reader goes by
``Content-Length`` alone, so a payload may hold anything. Files are gzip and end by
``file_bytes`` of records (or after one longer record); they are read as a stream,
so a reader's memory holds a compressed file and one record.

A null body is an empty payload. A null page id is no ``X-Page-Id`` field and comes
after every other id; a null url is no target. Control characters, spaces and
``%`` in urls are percent-encoded and read back. Repeated ids or rows are records of
their own. Empty tables give archives without records, and an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.llm.common import bounded_broadcast, discard, fresh_path, stored

MIN_BYTES = 100
FILE_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
MAX_BROADCAST_COPIES = 500_000
DATE = "2024-01-01T00:00:00Z"

# fixed values of the format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("file string, place long, record_type string, record_id string, page_id long, url string, payload_digest string, "
           "payload_bytes long, refers_to_id string, refers_to long, refers_to_url string")


def _head(fields: list[tuple[str, object]]) -> bytes:
    return "".join([VERSION, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def _record(kind: str, record_id: str, page_id, url, digest: str, size: int, payload: bytes, refers_id=None, refers_page=None, refers_url=None) -> bytes:
    """A record without the two line ends that follow its block."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    def target(u):
        return None if u is None else quote(u, safe="!#$&'()*+,/:;=?@[]~")

    return _head([
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", target(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", page_id),
        ("WARC-Profile", PROFILE if kind == "revisit" else None), ("WARC-Refers-To", f"<{refers_id}>" if refers_id else None),
        ("WARC-Refers-To-Target-URI", target(refers_url)), ("WARC-Refers-To-Date", DATE if refers_id else None), ("X-Refers-To-Page-Id", refers_page),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]) + block


END = b"\r\n\r\n"


def _packed(records: Iterator[bytes], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row per file: consecutive records, up to ``file_bytes`` or one longer record."""
    held, size = [], 0
    for r in records:
        if held and size + len(r) > file_bytes:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], ["value"])
            held, size = [], 0
        held.append(r)
        size += len(r) + len(END)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], ["value"])


def _write(files: DataFrame, path: str) -> None:
    """Each row becomes a file; the writer's line end closes the last record."""
    (files.select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   file_bytes: int = FILE_BYTES) -> None:
    """A response record per row of ``pages``, in gzip files below ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for page, url, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    body = body or b""
                    yield _record("response", f"urn:uuid:{uuid.uuid4()}", page, url, hashlib.sha256(body).hexdigest(), len(body), body)

        return _packed(records(), file_bytes)

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(body_col).cast("binary"))
    _write(rows.mapInArrow(run, "value binary"), path)


class _Stream:
    """Reads a gzip file piece by piece."""

    def __init__(self, raw: memoryview):
        self.raw, self.at, self.held, self.gz = raw, 0, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.gz.eof:
            if not self.gz.unused_data and self.at >= len(self.raw):
                return False
            rest, self.gz = self.gz.unused_data, zlib.decompressobj(31)
            self.held += self.gz.decompress(rest)
            return True
        if self.at >= len(self.raw):
            return False
        self.held += self.gz.decompress(self.raw[self.at: self.at + (1 << 18)])
        self.at += 1 << 18
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is taken too; None at the end of the file."""
        start = 0
        while (k := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record")
                return None
        out = bytes(self.held[:k])
        del self.held[: k + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _parsed(raw: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head fields by lower-case name, block) of each record."""
    stream = _Stream(raw)
    while (head := stream.until(END)) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        block = stream.take(int(fields["content-length"]))
        if stream.take(len(END)) != END:
            raise ValueError("a record's block is longer than its Content-Length")
        yield fields, block


def _rows(file: str, raw: memoryview, bodies: bool) -> Iterator[tuple]:
    def bare(v):
        return None if v is None else v.strip("<>")

    def whole(v):
        return None if v is None else int(v)

    def plain(v):
        return None if v is None else unquote(v)

    for place, (f, block) in enumerate(_parsed(raw)):
        http, _, payload = block.partition(END)
        size = next(int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length")
        digest, kind = f["warc-payload-digest"].partition(":")[2], f["warc-type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"record {f['warc-record-id']} differs from its head")
        yield (file, place, kind, bare(f["warc-record-id"]), whole(f.get("x-page-id")), plain(f.get("warc-target-uri")), digest, size,
               bare(f.get("warc-refers-to")), whole(f.get("x-refers-to-page-id")), plain(f.get("warc-refers-to-target-uri")),
               *([payload] if bodies else []))


def read_archives(spark: SparkSession, path: str, bodies: bool = False) -> DataFrame:
    """A row per record of the archives below ``path``; ``payload`` too if ``bodies``
    (empty for revisits). Payloads are checked against their heads as they are read."""
    schema = RECORDS + (", payload binary" if bodies else "")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                held, size = [], 0
                raw = memoryview(batch.column("content")[i].as_buffer())
                for row in _rows(batch.column("path")[i].as_py().rpartition("/")[2], raw, bodies):
                    held.append(row)
                    size += 400 + (len(row[-1]) if bodies else 0)
                    if size > BATCH_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def copies(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(file, place) of the records to become revisits, with their original's id, page and url."""
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "file", "place")
    rows = heads.where((F.col("payload_bytes") >= min_bytes) & (F.col("record_type") == "response")).withColumn("order", order)
    # a digest's original by partial aggregation: a digest in a third of all heads is a row per task
    first = rows.groupBy("payload_digest").agg(F.min(F.struct("order", "record_id", "url")).alias("o"), F.count("*").alias("n")).where(F.col("n") > 1)
    first = first.select("payload_digest", "n", F.col("o.order").alias("first_order"), F.col("o.record_id").alias("to_id"), F.col("o.order.page_id").alias("to_page"), F.col("o.url").alias("to_url"))
    return _with_original(rows, first, heads).where(F.col("order") != F.col("first_order")).select("file", "place", "to_id", "to_page", "to_url")


def _with_original(rows: DataFrame, first: DataFrame, heads: DataFrame) -> DataFrame:
    """``rows`` whose digest is in ``first``, joined to it."""
    first = stored(first, "warc_first")
    if first.count() <= MAX_BROADCAST_COPIES:
        return rows.join(F.broadcast(first), "payload_digest")
    # fewer than 1,000 digests can hold more than a thousandth of the heads each: these are broadcast, the others shuffled
    often = F.broadcast(first.where(F.col("n") * 1000 > heads.count()))
    rest = rows.join(often.select("payload_digest"), "payload_digest", "left_anti")
    return rows.join(often, "payload_digest").unionByName(rest.join(first, "payload_digest"))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Writes the archives below ``source`` again below ``target``, copies as revisits."""
    heads = stored(read_archives(spark, source), "warc_heads")
    decided = stored(copies(heads, min_bytes), "warc_copies")
    records = read_archives(spark, source, bodies=True)
    known = ["record_type", "record_id", "page_id", "url", "payload_digest", "payload_bytes", "payload", "refers_to_id", "refers_to", "refers_to_url"]
    rows = records.join(bounded_broadcast(decided, MAX_BROADCAST_COPIES), ["file", "place"], "left").select(*known, "to_id", "to_page", "to_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            for batch in batches:
                for kind, rid, page, url, digest, size, body, old_id, old_page, old_url, to_id, to_page, to_url in zip(*(c.to_pylist() for c in batch.columns)):
                    if to_id is not None:
                        yield _record("revisit", f"urn:uuid:{uuid.uuid4()}", page, url, digest, size, b"", to_id, to_page, to_url)
                    else:  # originals keep their id, which revisits refer to
                        yield _record(kind, rid, page, url, digest, size, body, old_id, old_page, old_url)

        return _packed(fresh(), file_bytes)

    _write(rows.mapInArrow(run, "value binary"), target)


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The contract's columns for ``page_id``, ``url`` and ``html``, read back from the deduplicated archives."""
    raw, final = fresh_path(spark, "warc_raw"), fresh_path(spark, "warc_final")
    write_archives(pages, raw)
    deduplicate(spark, raw, final)
    discard(spark, raw)
    return read_archives(spark, final).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def digest_sql(table: str = "pages") -> str:
    """DuckDB SQL for the contract's columns of :func:`digest`."""
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM {table}),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT page_id, n, h, CASE WHEN n >= {MIN_BYTES} THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS o FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN o = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN o <> page_id THEN o END AS refers_to
FROM f"""
