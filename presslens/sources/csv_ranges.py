"""CSV files with line breaks inside quotes, read in byte ranges, so that one large file is many tasks.

Whether a range begins inside quotes depends on all bytes before it. So the quotes of every range are counted first, many
ranges at once, and the parities of the ranges before it in its file say it. Then each task reads a range from that
state, owns the records that begin in it, and reads on past its end for the last one. Files of one range need no
count. Bytes come in chunks, so memory is bounded by the longest record.

Columns are matched by the header that every file begins with, of which only the first bytes are read. No path is
given back to a reader as a pattern, so file names may hold any characters. The driver gets the distinct headers and the number
of ranges only. The files may also come from a stream, batch by batch.

Quotes are as in RFC 4180: a field that holds a quote, a separator or a line break is quoted, a quote in it is doubled.
Files go through pyarrow's file systems. A compressed file (.gz, .bz2, .zst) cannot be cut and is one range.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors get these functions with the job, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 << 20
CHUNK = 4 << 20
# Different headers that one call may meet, and tasks that ranges are dealt to.
HEADERS = 1000
TASKS = 100_000
_COMPRESSED = r"\.(gz|bz2|zst)$"


def csv_files(spark: SparkSession, paths, listing: dict | None = None) -> DataFrame:
    """Files (path, length); `listing` has options that choose files. Their content is not read."""
    return spark.read.format("binaryFile").options(**listing or {}).load(paths).select("path", "length")


def stream_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream: each file that appears comes once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).load(folder).select("path", "length")


def opened(path: str):
    """An open file for a path as Spark names it."""
    if path.startswith("file:") or path.startswith("/"):
        name = path.removeprefix("file:")
        store, name = fs.LocalFileSystem(), "/" + name.lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    if path.endswith((".gz", ".bz2", ".zst")):
        return store.open_input_stream(name)
    return store.open_input_file(name)


def _quote_parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        odd = []
        for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            count = 0
            with opened(path) as source:
                source.seek(start)
                while start < end and (raw := source.read(min(CHUNK, end - start))):
                    count += raw.count(b'"')
                    start += len(raw)
            odd.append(count % 2)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(odd, pa.int32())], ["path", "start", "odd"])


def _dealt(ranges: DataFrame) -> DataFrame:
    """One range a task. The rows are tiny, so without a number of partitions they would all be put into one task."""
    return ranges.coalesce(1).repartition(max(1, min(ranges.count(), TASKS)))


def ranges_of(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges (path, start, end, inside) of files; `inside` says whether a range begins inside quotes."""
    last = F.when(F.col("path").rlike(_COMPRESSED), F.lit(0)).otherwise(F.floor((F.col("length") - 1) / range_bytes) * range_bytes)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(range_bytes).cast("long")))
    cut = files.where("length > 0").select("path", "length", (last > 0).alias("many"), starts.alias("start"))
    end = F.when(F.col("start") == last, F.col("length")).otherwise(F.col("start") + range_bytes)
    cut = cut.select("path", "start", end.cast("long").alias("end"), "many")
    parities = _dealt(cut.where("many").select("path", "start", "end")).mapInArrow(_quote_parities, "path string, start long, odd int")
    # A row per range, not per line, is left here.
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = parities.select("path", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    known = cut.drop("many").join(states, ["path", "start"], "left")
    return known.withColumn("inside", F.coalesce("inside", F.lit(False)))


def records_in_range(source, start: int, end: int, inside: bool, chunk: int = CHUNK) -> Iterator[tuple[bytes, np.ndarray]]:
    """Records that begin in (start, end], from 0 on where the range begins the file: bytes and the ends of records in them.

    The record that begins where the range ends is its own, so the next range passes over its first line end, in
    whatever way the border lies.
    """
    if start:
        source.seek(start)
    place, odd, passing = start, int(inside), start > 0
    # The open record: its bytes so far and where it begins.
    held: list[bytes] = []
    since = start
    while raw := source.read(chunk):
        data = np.frombuffer(raw, np.uint8)
        quoted = (np.cumsum(data == ord('"')) + odd) & 1
        odd = int(quoted[-1])
        ends = np.flatnonzero((data == ord("\n")) & (quoted == 0)) + 1
        begin = 0
        if passing:
            if not len(ends):
                place += len(raw)
                if place > end:
                    return
                continue
            begin, ends, passing = int(ends[0]), ends[1:], False
            since = place + begin
            if since > end:
                return
        # A record is owned if it begins at the end of the range or before.
        owned = ends[np.concatenate([[since - place], ends])[:-1] + place <= end] if len(ends) else ends
        if len(owned):
            before = sum(map(len, held))
            yield b"".join([*held, raw[begin : owned[-1]]]), owned - begin + before
            held, begin = [], int(owned[-1])
            since = place + begin
            if since > end:
                return
        held.append(raw[begin:])
        place += len(raw)
    if not passing and any(held):
        rest = b"".join(held)
        yield rest, np.array([len(rest)])


def _as_strings(raw: bytes, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    made = pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    try:
        made.validate(full=True)
    except pa.ArrowInvalid:
        # Bytes that are no UTF-8 are replaced, as Spark's own reader does.
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())
    return made.cast(pa.string())


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end, inside, header in zip(*(c.to_pylist() for c in batch.columns)):
            with opened(path) as source:
                first = start == 0
                for raw, ends in records_in_range(source, start, end, inside):
                    records = _as_strings(raw, ends)
                    records, first = records.slice(1) if first else records, False
                    name = path.rsplit("/", 1)[-1]
                    same = [pa.repeat(pa.scalar(v, pa.string()), len(records)) for v in (name, header)]
                    yield pa.RecordBatch.from_arrays([*same, records], ["file", "header", "record"])


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        headers = []
        for path in batch.column(0).to_pylist():
            with opened(path) as source:
                raw, ends = next(records_in_range(source, 0, 0, False, 1 << 14), (b"", [0]))
                headers.append(raw[: ends[0]].decode("utf-8", "replace").removeprefix("\ufeff").rstrip("\r\n"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(headers, pa.string())], ["path", "header"])


def _names(header: str, separator: str) -> list[str]:
    """Column names of a header; empty and repeated ones get their place."""
    found = next(csv.reader(header.splitlines(True), delimiter=separator), [])
    lowered = [n.lower() for n in found]
    return [f"_c{k}" if not n else f"{n}{k}" if lowered.count(n.lower()) > 1 else n for k, n in enumerate(found)]


def csv_table(files: DataFrame, separator: str = ",", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All columns that the files (path, length) have, as strings, and `file`; a column that a file lacks is null.

    Empty lines are no rows. A row with fewer values than its header has nulls, what it has beyond is left out.
    """
    # A stream may list files more than once in a batch where a name looks like a pattern.
    files = files.dropDuplicates(["path"])
    some = files.where("length > 0").select("path")
    tasks = files.sparkSession.sparkContext.defaultParallelism
    headers = some.repartition(tasks).mapInArrow(_read_headers, "path string, header string")
    found = headers.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").limit(HEADERS + 1).collect()
    if len(found) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers")
    named = {row["header"]: _names(row["header"], separator) for row in found}
    columns: dict[str, str] = {}
    for names in named.values():
        for name in names:
            columns.setdefault(name.lower(), name)
    if not columns:
        return files.select(F.col("path").alias("file")).where("false")
    widest = max(len(names) for names in named.values())
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    ranges = ranges_of(files, range_bytes).join(headers, "path").select("path", "start", "end", "inside", "header")
    records = _dealt(ranges).mapInArrow(_read_ranges, "file string, header string, record string")
    line = F.rtrim("record", F.lit("\r\n"))
    parsed = F.from_csv(line, ", ".join(f"c{k} string" for k in range(widest)), options)
    rows = records.where(line != "").select("file", "header", parsed.alias("v"))

    def value(key: str):
        made = F.lit(None).cast("string")
        for header, names in named.items():
            at = [k for k, n in enumerate(names) if n.lower() == key]
            if at:
                made = F.when(F.col("header") == header, F.col(f"v.c{at[0]}")).otherwise(made)
        return made

    return rows.select(*[value(key).alias(name) for key, name in columns.items()], "file")
