"""Benchmark decontamination with spaced seeds.

A mask names the places of a stretch of words that count; the others may differ. For each mask the words
of every benchmark item and of every document are hashed at all positions, and equal hashes are hits. A hit
fixes how the document and the item lie against each other. Along that line a stretch counts if it has `LEAST`
words (or as many as a shorter item has) and `AGREE` of them agree, wherever the others are; all of them that
lie in no longer one are reported. So passages with some words replaced are found too.

The masks miss no such stretch: with a fifth of the words replaced at any places, one of `MASKS` still fits in 13,
15, 20 and 25 words, the other lengths up to 25 hold one of these, and a longer stretch has a part of 13 to 25 words
in which no larger share is replaced. An item of 7 to 12 words keeps three words in a row (`SHORT`).

The benchmark goes to the tasks in blocks of about `BLOCK_WORDS` words, each a pass over the documents, so
what is broadcast is bounded however large the benchmark is. Documents are not shuffled.

Defined results: a stretch that is no whole item is reported without the differing words at its ends, except as
many as `LEAST` asks for; words are compared with A-Z in lower case; null or empty texts and items match nothing;
items with fewer than `FEWEST` words are never reported; null ids are handed through; repeated rows
are reported once per row; empty tables give an empty result. Documents are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import tokens
from presslens.llm.common import unused

# Fixed masks for items of `LEAST` words or more: six words that count within six, seven and eleven.
MASKS = ("111111", "1111011", "11001000111", "11010110001")
# The mask for items of `FEWEST` words or more that have fewer than `LEAST`.
SHORT = "111"
FEWEST = 7
LEAST = 13
AGREE = 0.8
# Hits handled at a time.
HITS = 1 << 20
BLOCK_WORDS = 1 << 20
_BITS = 20
_SCHEMA = "doc_id long, item_id long, doc_start long, doc_end long, item_start long, item_end long, n_agree long"
_NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]


def _places(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


class Block:
    """Seeds of a block of benchmark items: sorted hashes with the place each comes from."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.words, self.rows = tokens.word_hashes(pa.array(texts, pa.string()), fold=True)
        self.seeds = []
        size = np.repeat(np.diff(self.rows), np.diff(self.rows))
        for mask in (*MASKS, SHORT):
            asked = (size >= FEWEST) & (size < LEAST) if mask == SHORT else size >= LEAST
            hashes = tokens.grams(self.words, _places(mask))
            good = np.flatnonzero(tokens.inside_rows(self.rows, len(mask), len(hashes)) & asked[: len(hashes)])
            if not len(good):
                continue
            order = np.argsort(hashes[good], kind="stable")
            held = np.zeros(1 << _BITS, bool)
            held[hashes[good] >> np.uint64(64 - _BITS)] = True
            self.seeds.append((_places(mask), hashes[good][order], good[order], held))

    def hits(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distinct (row, item, shift) of seeds that the rows share with items, where enough words agree at all."""
        found = [np.empty((0, 3), np.int64)]
        for places, seeds, origin, held in self.seeds:
            hashes = tokens.grams(words, places)
            at = np.flatnonzero(held[hashes >> np.uint64(64 - _BITS)])
            low, high = np.searchsorted(seeds, hashes[at], "left"), np.searchsorted(seeds, hashes[at], "right")
            at, low, high = at[low < high], low[low < high], high[low < high]
            row = np.searchsorted(rows, at, "right") - 1
            whole = at + places[-1] < rows[row + 1]
            at, row, low, n = at[whole], row[whole], low[whole], (high - low)[whole]
            total = np.cumsum(n)
            cuts = np.searchsorted(total, np.arange(HITS, total[-1] if len(n) else 0, HITS))
            for part in np.split(np.arange(len(at)), cuts):
                # Each hit with each place of the benchmark that has the seed.
                m = n[part]
                first = np.repeat(np.cumsum(m) - m, m)
                origins = origin[np.repeat(low[part], m) + np.arange(m.sum()) - first]
                item = np.searchsorted(self.rows, origins, "right") - 1
                shift = (np.repeat(at[part] - rows[row[part]], m)) - (origins - self.rows[item])
                lines = np.unique(np.stack([np.repeat(row[part], m), item, shift], 1), axis=0)
                found.append(self._whole(words, rows, lines) if places == _places(SHORT) else lines)
        return np.unique(np.concatenate(found), axis=0)

    def _whole(self, words: np.ndarray, rows: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """The lines along which a whole short item lies inside the row and agrees."""
        row, item, shift = lines.T
        size = self.rows[item + 1] - self.rows[item]
        lines, size = (x[(shift >= 0) & (rows[row] + shift + size <= rows[row + 1])] for x in (lines, size))
        row, item, shift = lines.T
        agree = np.zeros(len(lines), np.int64)
        for k in range(LEAST - 1):
            inside = np.minimum(k, size - 1)
            same = words[rows[row] + shift + inside] == self.words[self.rows[item] + inside]
            agree += same & (k < size)
        good, bad = _weights()
        return lines[good * agree >= bad * (size - agree)]

    def overlaps(self, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple]:
        """(row, item, doc_start, doc_end, item_start, item_end, n_agree) of the overlaps that count."""
        for row, item, shift in self.hits(words, rows).tolist():
            text, whole = words[rows[row] : rows[row + 1]], self.words[self.rows[item] : self.rows[item + 1]]
            low, high = max(0, -shift), min(len(whole), len(text) - shift)
            same = text[low + shift : high + shift] == whole[low:high]
            for start, end in _stretches(same, min(LEAST, len(whole)), high - low == len(whole)):
                agree = int(same[start:end].sum())
                yield row, item, low + start + shift, low + end + shift, low + start, low + end, agree


def _weights() -> tuple[int, int]:
    """What an agreement and a difference weigh, so that `AGREE` agree if the sum is not negative."""
    share = Fraction(AGREE).limit_denominator(1000)
    return share.denominator - share.numerator, share.numerator


def _stretches(same: np.ndarray, least: int, whole: bool) -> list[tuple[int, int]]:
    """The stretches of `least` words or more, `AGREE` of which agree, that lie in no longer one.

    Differing words at the ends are left out as far as `least` words remain, unless all of `same` is such a
    stretch and `whole`.
    """
    n = len(same)
    good, bad = _weights()
    if n < least or good * np.count_nonzero(same) < bad * (least - np.count_nonzero(same)):
        return []
    total = np.concatenate([[0], np.cumsum(np.where(same, good, -bad))])
    if whole and total[-1] >= 0:
        return [(0, n)]
    # For each start the last end with a sum of 0 or more: the last place from which on the sums reach it.
    reached = np.maximum.accumulate(total[::-1])
    end = n - np.searchsorted(reached, total)
    first = np.concatenate([[True], end[1:] > np.maximum.accumulate(end)[:-1]])
    start = np.flatnonzero(first & (end - np.arange(n + 1) >= least))
    end, agree = end[start], np.flatnonzero(same)
    if not len(start):
        return []
    start, end = agree[np.searchsorted(agree, start)], agree[np.searchsorted(agree, end) - 1] + 1
    end = np.maximum(end, np.minimum(start + least, n))
    start = np.minimum(start, end - least)
    found: list[tuple[int, int]] = []
    for a, b in sorted(set(zip(start.tolist(), end.tolist())), key=lambda s: (s[0], -s[1])):
        if not found or b > found[-1][1]:
            found.append((a, b))
    return found


def blocks(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> Iterator[Block]:
    """The items that can be found, a bounded block at a time."""
    items = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    items = items.where(F.col("text").isNotNull())
    words = items.select(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    parts = max(1, -(-words // BLOCK_WORDS))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))
    for part in range(parts):
        rows = dealt.where(F.col("part") == part).select("id", "text").collect()
        if rows:
            yield Block([r["id"] for r in rows], [r["text"] for r in rows])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per overlap of a document (doc_id, text) with a benchmark item (item_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], _SCHEMA)
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            for batch in tokens.parts(batches, 1):
                words, ends = tokens.word_hashes(batch.column(1), fold=True)
                out = list(sent.value.overlaps(words, ends))
                ids = batch.column(0).take(pa.array([o[0] for o in out], pa.int64()))
                items = pa.array([sent.value.ids[o[1]] for o in out], pa.int64())
                rest = [pa.array([o[k] for o in out], pa.int64()) for k in range(2, 7)]
                yield pa.RecordBatch.from_arrays([ids, items, *rest], _NAMES)

        found = found.unionByName(rows.mapInArrow(scan, _SCHEMA))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that overlap with no item, with all their columns."""
    spark, kept = docs.sparkSession, docs
    name, last = unused(docs, "_scanned"), len(docs.columns)
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            for batch in tokens.parts(batches, last):
                words, ends = tokens.word_hashes(batch.column(last), fold=True)
                clean = np.ones(batch.num_rows, bool)
                clean[[o[0] for o in sent.value.overlaps(words, ends)]] = False
                yield batch.select(list(range(last))).filter(pa.array(clean))

        kept = kept.withColumn(name, F.col("text").cast("string")).mapInArrow(scan, docs.schema)
    return kept
