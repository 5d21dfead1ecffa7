"""Substring deduplication by recompression: repeats of `WINDOW` words across documents.

Naming. In `ROUNDS` rounds the symbols of every document are renamed: runs of one symbol, and
neighbours of which a coin of their names says left and right become one symbol. A name is a hash of
what it stands for, so all tasks give the same name to the same run or pair and equal substrings get the same
symbols inside, whatever surrounds them. For every symbol the words that it depends on are tracked. Of the last
round, symbols smaller than both neighbours are anchors. An anchor is named by the `CONTEXT` words around its middle, too,
since a few common words in a row meet by chance in ever more documents as a corpus grows.

Revealing. A Spark round counts in which documents each anchor name occurs. A window can only be a repeat
if all anchors that depend on nothing outside it are shared by two documents (a window without such an
anchor always may be). The anchors that are shared go back to their documents by a join.

Verifying. The windows that are left are hashed to 128 bits, the smallest document of each hash is found,
and the windows of later documents are joined with it. Documents equal to an earlier one as a whole are settled by
their digest and send no windows.

Nothing is grouped per name but smallest and largest ids, combined in each task; hot names and hot windows
meet their occurrences in joins that AQE can split. Windows meet by shuffle at every size; what goes back to the documents
is broadcast if it is below `BROADCAST_BYTES`, else joined by shuffle.

Defined results: a null or empty text has no words; texts shorter than a window lose nothing; a null id
counts as larger than all others; rows that repeat an id never remove words from each other; an empty
table gives an empty result. Only `doc_id` and `text` are read. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm import tokens
from presslens.llm.common import small, words_of, written

WINDOW = 50
ROUNDS = 4
# Runs are named in so many of the first rounds; every such round widens what a symbol depends on.
RUN_ROUNDS = 1
# Words around the middle of an anchor that its name also stands for.
CONTEXT = 28
BROADCAST_BYTES = 32 << 20
_LAST = (1 << 63) - 1
_FAR = 1 << 60


def _runs(names: np.ndarray, low: np.ndarray, high: np.ndarray, row: np.ndarray):
    """Runs of one symbol become one; its name does not depend on how long the run is."""
    same = np.zeros(len(names), bool)
    same[1:] = (names[1:] == names[:-1]) & (row[1:] == row[:-1])
    if not same.any():
        return names, low, high, row
    start = np.flatnonzero(~same)
    end = np.append(start[1:], len(names)) - 1
    long = end > start
    named = names[start].copy()
    named[long] = tokens.mixed(named[long] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return named, low[start], high[end], row[start]


def _pairs(names: np.ndarray, low: np.ndarray, high: np.ndarray, row: np.ndarray, number: int):
    """A left symbol and the right symbol after it become one."""
    right = (tokens.mixed(names + np.uint64(number + 1)) >> np.uint64(63)).astype(bool)
    joined = np.zeros(len(names), bool)
    joined[:-1] = ~right[:-1] & right[1:] & (row[1:] == row[:-1])
    gone = np.zeros(len(names), bool)
    gone[1:] = joined[:-1]
    named = names.copy()
    at = np.flatnonzero(joined)
    named[at] = tokens.mixed(names[at] * tokens.GRAM[0] + names[at + 1] * tokens.GRAM[1])
    # Whether a symbol is joined is seen from its neighbours, and a run from where it ends.
    before, after = _reach(low, high, row)
    after[at] = after[at + 1]
    keep = ~gone
    return named[keep], before[keep], after[keep], row[keep]


def _reach(low: np.ndarray, high: np.ndarray, row: np.ndarray):
    """What the neighbours depend on. Where a document ends, what would follow elsewhere is unknown."""
    before, after = np.full(len(low), -_FAR), np.full(len(high), _FAR)
    near = row[1:] == row[:-1]
    before[1:][near] = np.minimum(low[1:][near], low[:-1][near])
    after[:-1][near] = np.maximum(high[:-1][near], high[1:][near])
    return before, after


def anchors(words: np.ndarray, rows: np.ndarray):
    """Names of the anchors of all rows, the words [low, high) that each depends on, and their rows."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    names, low, high = words.copy(), np.arange(len(words)), np.arange(1, len(words) + 1)
    if not len(names):
        return names, low, high, row
    for number in range(ROUNDS):
        if number < RUN_ROUNDS:
            # A run ends where a neighbour differs, so what it depends on reaches one symbol further.
            names, low, high, row = _runs(names, *_reach(low, high, row), row)
        names, low, high, row = _pairs(names, low, high, row, number)
    edge = np.zeros(len(names), bool)
    edge[0] = edge[-1] = True
    edge[1:] |= row[1:] != row[:-1]
    edge[:-1] |= row[1:] != row[:-1]
    least = ~edge
    least[1:-1] &= (names[1:-1] < names[:-2]) & (names[1:-1] < names[2:])
    low, high = _reach(low, high, row)
    at = np.flatnonzero(least)
    return _in_context(words, rows, names[at], low[at], high[at], row[at])


def _in_context(words: np.ndarray, rows: np.ndarray, names: np.ndarray, low: np.ndarray, high: np.ndarray, row: np.ndarray):
    """The anchors whose context lies in their document, named by it and depending on it.

    Where it would leave the document, the same anchor elsewhere may have another one, so such an anchor rules nothing out.
    """
    start = (low + high - CONTEXT) // 2
    low, high = np.minimum(low, start), np.maximum(high, start + CONTEXT)
    at = np.flatnonzero((low >= rows[row]) & (high <= rows[row + 1]))
    start, named = start[at], names[at].copy()
    for k in range(CONTEXT):
        named += words[start + k] * tokens.GRAM[k + 2]
    return tokens.mixed(named), low[at], high[at], row[at]


def possible(low: np.ndarray, high: np.ndarray, shared: np.ndarray, n: int) -> np.ndarray:
    """Which windows of a document of `n` words can be repeats; its anchors are in order."""
    count = n - WINDOW + 1
    if count <= 0:
        return np.empty(0, np.int64)
    # Unshared anchors [low, high) rule out the windows that contain them.
    bad = np.flatnonzero(~shared)
    first, last = np.maximum(high[bad] - WINDOW, 0), np.minimum(low[bad], count - 1)
    good = first <= last
    mark = np.zeros(count + 1, np.int64)
    np.add.at(mark, first[good], 1)
    np.add.at(mark, last[good] + 1, -1)
    return np.flatnonzero(np.cumsum(mark[:-1]) == 0)


def _window_hashes(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers per window: sums of words, each times the power of its place."""
    result = []
    for factor in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x2545F4914F6CDD1D)):
        values = tokens.mixed(words ^ factor)
        power = np.full(WINDOW, factor)
        power = np.cumprod(power)
        total = np.zeros(len(at), np.uint64)
        for k in range(WINDOW):
            total += values[at + k] * power[k]
        result.append(tokens.mixed(total).view(np.int64))
    return result[0], result[1]


def _order(id_column: Column) -> Column:
    return F.coalesce(id_column.cast("long"), F.lit(_LAST))


def _named(rows: DataFrame) -> DataFrame:
    """(name, key, ord, at) of every anchor; `at` is its number within the document."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, 2):
            words, ends = tokens.word_hashes(batch.column(2))
            names, _, _, row = anchors(words, ends)
            number = np.arange(len(row)) - np.searchsorted(row, row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.view(np.int64)),
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array(number.astype(np.int32)),
                ],
                ["name", "key", "ord", "at"],
            )

    return rows.select("key", "ord", "text").mapInArrow(name, "name long, key long, ord long, at int")


def _windows(rows: DataFrame) -> DataFrame:
    """(h1, h2, key, ord, at) of the windows that can be repeats; `shared` lists a row's shared anchors."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.parts(batches, 2):
            words, ends = tokens.word_hashes(batch.column(2))
            _, low, high, row = anchors(words, ends)
            borders = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i, known in enumerate(batch.column(3)):
                a, b, begin, end = borders[i], borders[i + 1], ends[i], ends[i + 1]
                shared = np.zeros(b - a, bool)
                if known.is_valid:
                    numbers = known.values.to_numpy()
                    shared[numbers[numbers < b - a]] = True
                at = possible(low[a:b] - begin, high[a:b] - begin, shared, end - begin)
                if len(at):
                    one, two = _window_hashes(words[begin:end], at)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(one),
                            pa.array(two),
                            pa.array(np.full(n, batch.column(0)[i].as_py())),
                            pa.array(np.full(n, batch.column(1)[i].as_py())),
                            pa.array(at.astype(np.int32)),
                        ],
                        ["h1", "h2", "key", "ord", "at"],
                    )

    return rows.select("key", "ord", "text", "shared").mapInArrow(
        hashed, "h1 long, h2 long, key long, ord long, at int"
    )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Per document key the ranges of window starts (first, last) that an earlier document has, and `copied`.

    The key is a hash of id and text. Two documents that share it only give each other more windows to verify.
    """
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("key"), _order(F.col("doc_id")).alias("ord"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Documents that repeat an earlier one as a whole.
    words = words_of(F.col("text"))
    digests = rows.select("key", "ord", F.md5(F.array_join(words, " ").cast("binary")).alias("md5"), F.size(words).alias("n"))
    # Written, since both sides of the join below read it.
    digests = written(digests.where(F.col("n") >= WINDOW).select("key", "ord", "md5"), "digests")
    groups = digests.groupBy("md5").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last")
    copies = digests.join(groups, "md5").where(F.col("ord") > F.col("first")).select("key").distinct()
    # Anchors that two documents share go back to the documents.
    named = _named(rows)
    ids = named.groupBy("name").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    common = written(ids.where("first < last").select("name"), "names")
    back = named.join(small(common, BROADCAST_BYTES), "name").groupBy("key").agg(F.collect_set("at").alias("shared"))
    told = back.join(copies.withColumn("copied", F.lit(True)), "key", "full_outer")
    told = written(told.select("key", "shared", F.coalesce("copied", F.lit(False)).alias("copied")), "shared")
    # Windows of the documents that are left; one without anchors at all may have some, too.
    asked = rows.join(small(told, BROADCAST_BYTES), "key", "left").where(~F.coalesce("copied", F.lit(False)))
    windows = written(_windows(asked), "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    # Written, so that the join is a stage of its own, which AQE can split; it is shuffled at every size.
    first = written(first.where("first < last").select("h1", "h2", "first"), "first")
    later = windows.join(first.hint("shuffle_merge"), ["h1", "h2"]).where(F.col("ord") > F.col("first"))
    starts = later.groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("at"))
    at = F.col("at")
    begun = F.filter(at, lambda x, i: F.coalesce(F.get(at, F.when(i > 0, i - 1)) != x - 1, F.lit(True)))
    ended = F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) != x + 1, F.lit(True)))
    ranges = starts.select("key", begun.alias("first"), ended.alias("last"), F.lit(False).alias("copied"))
    none = F.array().cast("array<int>")
    whole = told.where("copied").select("key", none.alias("first"), none.alias("last"), F.lit(True).alias("copied"))
    return ranges.unionByName(whole)


def dedup_report(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row of `docs` (doc_id, text) its words, how many go, and the digest of the rest (or the rest)."""
    found = written(repeated_windows(docs), "ranges")
    rows = docs.select(
        F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("key")
    )
    joined = rows.join(small(found, BROADCAST_BYTES), "key", "left").select("doc_id", "text", "first", "last", "copied")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, first, last, copied in zip(*(batch.column(k) for k in range(1, 5))):
                words = text.as_py().encode().split()
                n, kept = len(words), words
                if copied.as_py():
                    kept = []
                elif first.is_valid:
                    mark = np.zeros(n + 1, np.int64)
                    np.add.at(mark, first.values.to_numpy(), 1)
                    np.add.at(mark, last.values.to_numpy() + WINDOW, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0)]
                rest = b" ".join(kept)
                out.append((n, n - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode() if with_text else None))
            columns = [batch.column(0), *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = [pa.int64(), pa.int64(), pa.string()] + ([pa.string()] if with_text else [])
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["kept_text"] if with_text else [])
    identity = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {identity}, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.mapInArrow(cut, schema)
