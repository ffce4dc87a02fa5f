"""WARC archives of pages: writing, and a sequential reader.

An archive is a row (`archive`, `content`): one gzip member per record, one after the other, as in a ``.warc.gz``
file. Archives are written as Parquet through Spark, so they can lie in any store that Spark writes to, and
`read_records` also takes what Spark's ``binaryFile`` source reads from ordinary ``.warc.gz`` files.

The reader inflates one member at a time from the bytes, takes the block by its Content-Length and checks the
digest; memory is one archive and one record. A broken record raises with the archive's name and the position.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import stage

ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("archive string, position long, page_id long, url string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, payload binary, digest_ok boolean")


def payload(html: Column) -> Column:
    """The html in UTF-8; NULL is empty."""
    return F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))


def sealed_pages(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """page_id, url, payload and digest; and, stored, each repeated digest of `least` bytes with its smallest page_id.

    Only digests that occur more than once are stored and joined back. Spark knows that table's size: while it is
    small, the payloads meet no shuffle, and beyond that a frequent digest is split at run time.
    """
    sealed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          payload(F.col("html")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    groups = (sealed.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    return sealed, stage(groups, "repeated-payloads")


def record(page_id, url, body: bytes, digest: str, refers_to) -> bytes:
    """One gzip member: a response, or a revisit without block that names its response."""
    revisit = refers_to is not None
    block = b"" if revisit else body
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: text/html; charset=utf-8",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(body)}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.encode("unicode_escape").decode("ascii"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES,
                   least: int = LEAST_REVISIT_BYTES) -> None:
    """A record for each row of `pages` (page_id, url, html; other columns are left out), as archives under `path`.

    Each task packs its rows in turn and starts a new archive after `archive_bytes`; names hold the task's number, so
    a repeated attempt writes the same archives. Of rows with one payload, those with the smallest page_id are
    responses (all rows that repeat this id); rows without page_id are responses. An empty table gives no archives.
    """
    sealed, groups = sealed_pages(pages, least)
    rows = sealed.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", F.when(
        F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"),
        F.spark_partition_id().alias("task"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, name = [], 0, ""
        n = 0

        def sealed_archive():
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([b"".join(held)], pa.binary())], ["archive", "content"])
        for batch in batches:
            for page_id, url, body, digest, refers_to, task in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"pages-{task:06d}-{n:06d}.warc.gz"
                held.append(record(page_id, url, body, digest, refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield sealed_archive()
                    held, size, n = [], 0, n + 1
        if held:
            yield sealed_archive()
    rows.mapInArrow(pack, "archive string, content binary").write.parquet(path)


class Members:
    """The inflated gzip members of some bytes, one after the other, each with its position."""

    def __init__(self, content: bytes, chunk: int = 1 << 16):
        self.content, self.chunk = memoryview(content), chunk

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        at = 0
        while at < len(self.content):
            start, parts, inflate = at, [], zlib.decompressobj(31)
            while not inflate.eof:
                piece = self.content[at:at + self.chunk]
                if not piece:
                    raise ValueError(f"member at {start} ends early")
                parts.append(inflate.decompress(piece))
                at += len(piece)
            at -= len(inflate.unused_data)
            yield start, b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and the block of Content-Length bytes."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC header")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block is not {length} bytes")
    return headers, rest[:length]


def read_records(archives: DataFrame) -> DataFrame:
    """A row per record of archives (`archive`, `content`), in the columns of `RECORDS`.

    Payload digest and length are those of the full payload, also for revisits, whose `payload` is NULL. `digest_ok`
    tells whether the stored block agrees with its block digest and, in a response, with the payload digest.
    """
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("position", pa.int64()), ("page_id", pa.int64()),
                            ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                            ("digest_ok", pa.bool_())])
        for batch in batches:
            for archive, content in zip(batch["archive"].to_pylist(), batch["content"]):
                rows, size = [], 0
                for position, member in Members(content.as_buffer()):
                    try:
                        headers, block = parse(member)
                    except (ValueError, KeyError) as e:
                        raise ValueError(f"{archive} at {position}: {e}") from e
                    found = hashlib.sha256(block).hexdigest()
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    revisit = headers["warc-type"] == "revisit"
                    number = {k: int(headers[k]) if k in headers else None for k in ("x-page-id", "x-refers-to-page")}
                    url = headers.get("warc-target-uri")
                    rows.append((archive, position, number["x-page-id"],
                                 None if url is None else url.encode("ascii").decode("unicode_escape"),
                                 headers["warc-type"], number["x-refers-to-page"],
                                 int(headers.get("x-payload-length", len(block))), digest, None if revisit else block,
                                 found == headers["warc-block-digest"].removeprefix("sha256:")
                                 and (revisit or found == digest)))
                    size += len(member)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    return archives.select("archive", "content").mapInArrow(unpack, RECORDS)
