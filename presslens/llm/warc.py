"""WARC archives: writing one record per page, and a splittable reader.

Writing. Pages whose payloads are equal (SHA-1, at least `REVISIT_BYTES` bytes) are written once, as the
response of the page with the largest id; the others become revisit records that refer to it. Each task
writes gzip members, one per record, to a file of its own name and reports it when it is closed. A repeated
or speculative task writes another file; only files in the report are read.

Reading. Every file is cut into byte ranges. A task scans its range for the gzip magic, takes a place for a
member if decoding there gives the first line of a WARC record, and owns the records that start inside
its range; it reads on past the end for the last one. Nothing but the ranges is held at a time: bytes come in
chunks, and a record is decoded as a whole only when it is handed out.

Defined results: a null html is an empty payload, a null url an empty target; a null page id is written as
`null`, never is the response of others unless all are null, in which case every page is one; pages that
repeat the largest id are all responses. An empty table gives no files and an empty result. Files go through
pyarrow's file systems, so the folder may be in any store these know.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import new_folder, written

REVISIT_BYTES = 1000
RANGE_BYTES = 4 << 20
# Tasks that ranges are dealt to; beyond that a task has several.
TASKS = 100_000
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
_FILES = "path string, size long, records long"
_RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
_DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def plan_records(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, payload_digest, refers_to) with the response of each revisit.

    Only ids and digests are grouped. The payloads meet the groups of equal ones in a left join, in
    which AQE may split a hot digest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("payload_digest"),
    )
    shared = (
        rows.where(F.length("payload") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    other = F.col("last").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("last")))
    return rows.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(other, F.col("last")).alias("refers_to")
    )


def _member(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member that holds one WARC record."""
    name = lambda n: f"<urn:page:{'null' if n is None else n}>"
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {_DATE}",
        # White space and control characters would end the line.
        f"WARC-Target-URI: {quote(url, safe='/:?#[]@!$&()*+,;=-._~' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[3:3] = [
            f"WARC-Refers-To: {name(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(record) + packer.flush()


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write `plan_records` rows below `folder`; the report of finished files (path, size, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path, out, size, count = f"{root}/part-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    out = store.open_output_stream(path, compression=None)
                member = _member(*row)
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": [size], "records": [count]})

    rows = records.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return written(rows.mapInArrow(write, _FILES), "warc-files")


class _Window:
    """Bytes of a file from some place on, read in chunks as far as asked for."""

    def __init__(self, source, start: int):
        self.source, self.start, self.data, self.ended = source, start, bytearray(), False

    def at(self, place: int, size: int) -> bytes:
        while len(self.data) < place - self.start + size and not self.ended:
            more = self.source.read_at(CHUNK, self.start + len(self.data))
            self.ended = not more
            self.data += more
        return bytes(self.data[place - self.start : place - self.start + size])

    def drop_before(self, place: int) -> None:
        del self.data[: place - self.start]
        self.start = place


def _decode(window: _Window, place: int) -> tuple[bytes, int] | None:
    """The record of the gzip member at a place and where it ends, or None if none starts there."""
    opener, record, at, known = zlib.decompressobj(31), bytearray(), place, False
    try:
        while not opener.eof:
            # A little is enough to see what is no member.
            more = window.at(at, CHUNK if known else 512)
            if not more and known:
                raise EOFError(f"the member at byte {place} is cut off")
            if not more:
                return None
            at += len(more)
            record += opener.decompress(more)
            known = known or len(record) >= 7
            if known and not record.startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    return (bytes(record), at - len(opener.unused_data)) if known else None


def records_in_range(source, start: int, end: int) -> Iterator[bytes]:
    """Records whose members start in [start, end) of an open file, in order."""
    window, place = _Window(source, start), start
    while place < end:
        held = window.at(place, CHUNK)
        if not held:
            return
        step = held.find(MAGIC)
        if step < 0 or place + step >= end:
            # The magic may lie across the border of two chunks.
            place += max(1, len(held) - len(MAGIC) + 1) if step < 0 else step
            window.drop_before(min(place, window.start + len(window.data)))
            continue
        place += step
        window.drop_before(place)
        found = _decode(window, place)
        if found is None:
            place += 1
        else:
            yield found[0]
            place = found[1]
            window.drop_before(place)


def parse_record(record: bytes) -> dict:
    """The fields of one record; the payload of a response is what follows its HTTP head."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(re.findall(rb"^([^:\r\n]+): ?([^\r\n]*)", head, re.M))
    number = lambda b: None if b is None or b == b"null" else int(b)
    named = lambda f: (m := re.search(rb"<urn:page:([^>]*)>", fields.get(f, b""))) and m[1]
    kind = fields[b"WARC-Type"].decode()
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    size = int(fields[b"X-Payload-Length"])
    block = block[: int(fields[b"Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload does not have the digest of its record")
    return {
        "page_id": number(named(b"WARC-Record-ID")),
        "url": unquote(fields[b"WARC-Target-URI"].decode()),
        "record_type": kind,
        "refers_to": number(named(b"WARC-Refers-To")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def read_warc(files: DataFrame, folder: str, range_bytes: int = RANGE_BYTES, payloads: bool = False) -> DataFrame:
    """Records of the reported files; with `payloads`, also the payload of each response."""
    schema = _RECORDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        kind = pa.schema(list(zip(names, types)))
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as source:
                    rows, held = [], 0
                    for record in records_in_range(source, start, end):
                        rows.append(parse_record(record))
                        held += len(record)
                        if held > 8 << 20 or len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=kind)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("size > 0").select("path", starts.alias("start"))
    ranges = ranges.select("path", "start", (F.col("start") + range_bytes).alias("end"))
    # One range is a unit of work. The rows are tiny, so without a number of partitions they would all be one task.
    return ranges.coalesce(1).repartition(max(1, min(ranges.count(), TASKS))).mapInArrow(read, schema)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages as WARC below the shared folder and read the archives back."""
    folder = new_folder(spark, "warc")
    files = write_warc(plan_records(pages.select("page_id", "url", "html")), folder)
    return read_warc(files, folder)


# The same rows from DuckDB. The target is not compared: it is written percent-encoded.
ARCHIVE_SQL = """WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM p),
r AS (SELECT *, n >= 1000 AND last IS NOT NULL AND (page_id IS NULL OR page_id < last) AS again FROM g)
SELECT page_id, coalesce(url, '') AS url, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to FROM r"""
