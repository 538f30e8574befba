"""WARC archives with revisit records.

Headers are shuffled by payload digest to find originals: of records with equal payloads of at least
MIN_BYTES bytes the one of smallest page_id is the original response; the others become revisit
records. Payloads stay where they were read: originals (one row for each payload that repeats) are
broadcast if they are counted at most MOST_ORIGINALS. Beyond that, records of at least MIN_BYTES
bytes are joined to them by a shuffle, which moves those payloads once.

Archives have fresh headers, one gzip member for each record (one more, empty, ends a group), and
are cut by bytes: a group is closed once it has GROUP_BYTES, a file holds FILE_GROUPS groups, so that only
a single longer record makes a longer file. Spark's text writer commits the files. They are read back member
by member, from the files alone; what a revisit refers to is found again by joining
revisits to original responses.

A null html is an empty payload. Records with a null page_id are all responses, and are never
referred to. Rows that repeat the smallest page_id of a payload are all responses; ties do not
matter beyond that, and rows that are equal in all columns have one record id. A very long payload must fit in memory, several
times; extra columns are ignored. Empty tables give archives without records and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .common import shared_dir, written

MIN_BYTES = 100
#: Originals that are broadcast at most: some 60 MB.
MOST_ORIGINALS = 200_000
#: Compressed bytes that close a group of records, and groups in a file.
GROUP_BYTES, FILE_GROUPS = 4 << 20, 8
#: Compressed bytes that are handed to the decompressor at once.
FEED = 64 << 10
CRLF, END = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, record_type string, url string, record_id string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (text), payload_bytes and payload_digest (bare hex) of every page."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest")
    )


def resolve(recs: DataFrame) -> DataFrame:
    """Of every payload of MIN_BYTES bytes or more that several pages have: payload_digest, original (the smallest page_id) and original_url (the least, where rows repeat that page_id).

    Only headers are shuffled, and they are counted before the shuffle, so that a payload that a
    third of all pages have is one row for each task.
    """
    headers = recs.where((F.col("payload_bytes") >= MIN_BYTES) & F.col("page_id").isNotNull()).select("page_id", "url", "payload_digest")
    found = headers.groupBy("payload_digest").agg(F.min(F.struct("page_id", "url")).alias("least"), F.max("page_id").alias("last")).where("last > least.page_id")
    return found.select("payload_digest", F.col("least.page_id").alias("original"), F.col("least.url").alias("original_url"))


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A UUID that depends on the record alone: a task that runs again writes the same ids."""
    h = F.md5(F.concat_ws("\x1f", F.coalesce(page_id.cast("string"), F.lit("null")), url, digest).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.lit("a"), part(18, 3)), part(21, 12)), F.lit(">"))


def header(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(CRLF))).otherwise("")


def decided(recs: DataFrame, originals: DataFrame) -> DataFrame:
    """recs with original and original_url, null for responses; originals must be a written table, as it is counted."""
    if originals.count() <= MOST_ORIGINALS:
        joined = recs.join(F.broadcast(originals), "payload_digest", "left")
    else:
        none = recs.where(F.col("payload_bytes") < MIN_BYTES).select("*", F.lit(None).cast("long").alias("original"), F.lit(None).cast("string").alias("original_url"))
        joined = recs.where(F.col("payload_bytes") >= MIN_BYTES).join(originals.hint("merge"), "payload_digest", "left").unionByName(none)
    revisit = (F.col("payload_bytes") >= MIN_BYTES) & (F.col("page_id") > F.col("original"))
    return joined.withColumns({c: F.when(revisit, F.col(c)) for c in ("original", "original_url")})


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


#: Ends in a zero byte, as the size of what it holds is zero.
EMPTY_MEMBER = member(b"")


def groups_of_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gzip members of records, in groups that end with an empty one; the zero byte at the end of a group is left to the writer, as its line separator."""
    held, size = [], 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join([*held, EMPTY_MEMBER[:-1]])], pa.binary())], names=["value"])

    for batch in tk.slices(batches, "block"):
        for head, block in zip(batch.column("head"), batch.column("block")):
            held.append(member(b"".join([head.as_buffer(), block.as_buffer(), END.encode()])))
            size += len(held[-1])
            if size >= GROUP_BYTES:
                yield close()
                held, size = [], 0
    if held:
        yield close()


def write_archives(recs: DataFrame, originals: DataFrame, path: str, date: str | None = None) -> None:
    """Deduplicated archives of all records under path; date: of the records (now, if none is given)."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    joined = decided(recs, originals)
    revisit = F.col("original").isNotNull()
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{END}")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"))),
        header("WARC-Date", date),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        header("WARC-Page-ID", F.col("page_id")),
        header("WARC-Profile", F.when(revisit, PROFILE)),
        header("WARC-Refers-To", F.when(revisit, record_id(F.col("original"), F.col("original_url"), F.col("payload_digest")))),
        header("WARC-Refers-To-Target-URI", F.col("original_url")),
        header("WARC-Refers-To-Date", F.when(revisit, date)),
        header("WARC-Refers-To-Page", F.col("original")),
        header("Content-Type", "application/http; msgtype=response"),
        header("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
    )
    packed = joined.select(head.cast("binary").alias("head"), block.cast("binary").alias("block")).mapInArrow(groups_of_members, "value binary")
    # Bytes as they are: the writer neither checks nor compresses them.
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", FILE_GROUPS).text(path)


def members(content: memoryview) -> Iterator[bytes]:
    """What the gzip members of an archive hold, one at a time; empty ones are left out."""
    at = 0
    while at < len(content):
        packed, parts = zlib.decompressobj(31), []
        while not packed.eof:
            if at >= len(content):
                raise ValueError("an archive ends within a record")
            parts.append(packed.decompress(content[at : at + FEED]))
            at = min(at + FEED, len(content))
        at -= len(packed.unused_data)
        if any(parts):
            yield b"".join(parts)


def parse(content: memoryview) -> Iterator[dict]:
    """Records of an archive."""
    for record in members(content):
        stop = record.index(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in record[:stop].decode().split(CRLF)[1:] if ": " in x)
        block = record[stop + 4 : stop + 4 + int(fields["Content-Length"])]
        yield {"fields": fields, "payload": block[block.index(b"\r\n\r\n") + 4 :]}


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record in the archives under path; digests and sizes of responses are those of the bytes read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        rows: list[list] = []

        def filled() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for content in batch.column("content"):
                size = 0
                for rec in parse(memoryview(content.as_buffer())):
                    fields, payload = rec["fields"], rec["payload"]
                    revisit = fields["WARC-Type"] == "revisit"
                    page = fields.get("WARC-Page-ID")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
                    rows.append([int(page) if page is not None else None, fields["WARC-Type"], fields.get("WARC-Target-URI", ""), fields["WARC-Record-ID"], fields.get("WARC-Refers-To-Page"), digest, None if revisit else len(payload), payload if with_payload and not revisit else None])
                    size += len(payload) if with_payload else 0
                    if size > 8 << 20 or len(rows) >= 10_000:
                        yield filled()
                        rows, size = [], 0
                if rows:
                    yield filled()
                    rows = []

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def joined_revisits(recs: DataFrame) -> DataFrame:
    """Records read back, revisits with the size of the payload they refer to; the original is found by its page and digest."""
    revisit = F.col("record_type") == "revisit"
    heads = recs.select("page_id", "record_type", "payload_digest", "payload_bytes", F.col("refers_to_id").cast("long").alias("refers_to"))
    # One row for each referred-to payload; those that nothing refers to would only be carried along.
    originals = heads.where(~revisit & F.col("page_id").isNotNull() & (F.col("payload_bytes") >= MIN_BYTES))
    originals = originals.groupBy(F.col("payload_digest").alias("d")).agg(F.min("page_id").alias("p"), F.first("payload_bytes").alias("n"))
    out = heads.join(originals, revisit & (F.col("payload_digest") == F.col("d")) & (F.col("refers_to") == F.col("p")), "left")
    return out.select("page_id", F.when(revisit, F.col("n")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes deduplicated archives of the pages (under path, or a new shared folder) and returns the records read from them."""
    path = path or shared_dir(pages.sparkSession)
    recs = records(pages)
    write_archives(recs, written(resolve(recs)), path)
    return joined_revisits(written(read_archives(pages.sparkSession, path).drop("payload")))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {MIN_BYTES} GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id > first THEN first END AS refers_to
FROM p LEFT JOIN o ON p.d = o.d
"""
