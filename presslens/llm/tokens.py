"""Words of Arrow text columns as 64-bit numbers, made with NumPy from the column's bytes.

No Python object is made per word. A word's number is a sum of random values of its bytes, each times a
random factor of its place, mixed at the end; `fold` gives A-Z the values of a-z. The factors repeat after `PLACES`
bytes, so every further part of so many bytes is mixed by itself, with its number, before it is added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at a time; the arrays made for them are some ten times as large.
CHUNK = 1 << 18
PLACES = 256
_random = np.random.default_rng(20240229)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_SPACE] = 0
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_FACTORS = _random.integers(1, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRAM = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread each number over all its bits, one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty row."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, np.int64 if wide else np.int32)
    rows = rows[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[rows[0] : rows[-1]], rows - rows[0]


def parts(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in parts of about `most` bytes of text, so that arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = column_bytes(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, ends[start] + most, "right")) - 1, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def _pieces(raw: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about `CHUNK` bytes that end with a row or at white space."""
    start = 0
    while start < len(raw):
        end = min(start + CHUNK, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:
            row = rows[np.searchsorted(rows, end)]
            stop = min(row, end + 4096)
            spaces = np.flatnonzero(_SPACE[raw[end:stop]])
            end = end + int(spaces[0]) if len(spaces) else int(stop)
            if end == row:
                break
        yield start, end
        start = end


def word_places(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes starts and ends, in order."""
    space = _SPACE[raw]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    begins = rows[:-1][rows[:-1] < rows[1:]]
    ends = rows[1:][rows[:-1] < rows[1:]] - 1
    first[begins] = ~space[begins]
    last[ends] = ~space[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(raw: np.ndarray, first: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(first):
        return np.empty(0, np.uint64)
    raw, first = raw[first[0] :], first - first[0]
    span = np.diff(first, append=len(raw))
    place = np.arange(len(raw)) - np.repeat(first, span)
    if span.max() <= PLACES:
        return mixed(np.add.reduceat(values[raw] * _FACTORS[place], first))
    weighted = values[raw] * _FACTORS[place % PLACES]
    further = np.flatnonzero((place > 0) & (place % PLACES == 0))
    cuts = np.union1d(first, further)
    sums = np.add.reduceat(weighted, cuts)
    part = (place[cuts] // PLACES).astype(np.uint64)
    # White space behind a word adds nothing.
    more = (part > 0) & (sums != 0)
    sums[more] = mixed(sums[more] ^ mixed(part[more]))
    return mixed(np.add.reduceat(sums, np.searchsorted(cuts, first)))


def word_hashes(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words of a column and, per row, where its words begin (one more entry at the end)."""
    return hashes_and_ends(column, fold)[:2]


def hashes_and_ends(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `word_hashes`, and the last two bytes of each word (0 before a word of one byte), with A-Z as they are."""
    raw, rows = column_bytes(column)
    values = _FOLDED if fold else _BYTES
    hashes, starts, tails = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty((0, 2), np.uint8)]
    for a, b in _pieces(raw, rows):
        inside = np.unique(np.clip(rows, a, b)) - a
        piece = raw[a:b]
        first, last = word_places(piece, inside)
        hashes.append(_hashes(piece, first, values))
        starts.append(first + a)
        before = np.where(last - first > 1, piece[np.maximum(last - 2, 0)], 0).astype(np.uint8)
        tails.append(np.stack([before, piece[last - 1]], 1))
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(where, rows), np.concatenate(tails)


def grams(words: np.ndarray, places: list[int]) -> np.ndarray:
    """One number per start: the words at `places` behind it, in order; starts near the end are left out."""
    span = places[-1] + 1
    n = max(len(words) - span + 1, 0)
    total = np.zeros(n, np.uint64)
    for k, place in enumerate(places):
        total += words[place : place + n] * GRAM[k]
    return mixed(total)


def inside_rows(rows: np.ndarray, span: int, n: int) -> np.ndarray:
    """Which of `n` starts have `span` words left in their own row."""
    left = np.repeat(rows[1:], np.diff(rows))[:n]
    return np.arange(n) + span <= left
