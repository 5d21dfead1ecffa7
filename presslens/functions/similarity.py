"""Similarity of two short texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 64
# Machine words of one block of choices, and of one block times one batch of queries.
BLOCK_WORDS, BATCH_WORDS = 4096, 32768


def normalized(text: Column) -> Column:
    """Lower case, everything but letters, digits and underscores made a space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]", " "))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


class Block:
    """Choices of about the same length: one bit per character, compared all at once."""

    def __init__(self, choices: list[np.ndarray], at: np.ndarray):
        self.at = at
        self.lengths = np.array([len(choices[i]) for i in at], dtype=np.int64)
        self.words = words_of(int(self.lengths.max()))
        chars = np.concatenate([choices[i] for i in at])
        column = np.repeat(np.arange(len(at)), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(chars)) - np.repeat(starts, self.lengths)
        self.alphabet, code = np.unique(chars, return_inverse=True)
        # masks[code + 1, word, column]: where a choice has the character; code 0 is any other one.
        self.masks = np.zeros((len(self.alphabet) + 1, self.words, len(at)), dtype=np.uint64)
        bit = np.uint64(1) << (place % WORD_BITS).astype(np.uint64)
        np.bitwise_or.at(self.masks, (code + 1, place // WORD_BITS, column), bit)
        self.valid = np.bitwise_or.reduce(self.masks, axis=0)

    def encode(self, query: np.ndarray) -> np.ndarray:
        """The query in the block's codes, without the characters no choice has."""
        if not len(self.alphabet) or not len(query):
            return np.zeros(0, dtype=np.int64)
        near = np.minimum(np.searchsorted(self.alphabet, query), len(self.alphabet) - 1)
        return near[self.alphabet[near] == query] + 1

    def common_subsequences(self, queries: list[np.ndarray]) -> np.ndarray:
        """Length of the longest common subsequence of every query (row) with every choice (column).

        A bit of `free` stays set while its character is not yet part of the subsequence; one addition
        with carry per query character moves all choices on.
        """
        encoded = [self.encode(q) for q in queries]
        sizes = np.array([len(code) for code in encoded])
        # Longest query first, so the queries that still have characters left are always the first rows.
        order = np.argsort(-sizes, kind="stable")
        codes = np.zeros((int(sizes.max()), len(queries)), dtype=np.int64)
        for row, at in enumerate(order):
            codes[: sizes[at], row] = encoded[at]
        running = np.searchsorted(-sizes[order], -np.arange(len(codes)), side="left")
        state = np.full((len(queries), self.words, len(self.at)), ~np.uint64(0))
        for step, rows in zip(codes, running):
            free = state[:rows]
            hit = free & self.masks[step[:rows]]
            moved = free + hit
            if self.words > 1:
                carry = moved < free
                for word in range(1, self.words):
                    before = carry[:, word - 1]
                    moved[:, word] += before
                    carry[:, word] |= before & (moved[:, word] == 0)
            np.bitwise_xor(free, hit, out=free)
            np.bitwise_or(free, moved, out=free)
        free = np.empty_like(state)
        free[order] = state
        return np.bitwise_count(~free & self.valid).sum(axis=1, dtype=np.int64)


def words_of(length: int) -> int:
    return max(1, -(-length // WORD_BITS))


def blocks_of(choices: list[np.ndarray]) -> list[Block]:
    """Cut the choices, sorted by length, into blocks of bounded size and similar length."""
    order = np.argsort([len(c) for c in choices], kind="stable")
    blocks, start = [], 0
    for end in range(1, len(order) + 1):
        if end < len(order):
            widest, least = words_of(len(choices[order[end]])), words_of(len(choices[order[start]]))
            if widest <= 1.5 * least and (end + 1 - start) * widest <= BLOCK_WORDS:
                continue
        blocks.append(Block(choices, order[start:end]))
        start = end
    return blocks


def best_in(queries: list[str], choices: list[str], labels: list[str]) -> list[tuple[int, float]]:
    """For every query, the index and similarity (0 to 1) of the most similar choice.

    The similarity is twice the common subsequence over both lengths; ties go to the smallest label.
    Blocks are tried by falling upper bound of their lengths and left out for the queries that already
    have something better, so the result is exact.
    """
    blocks = blocks_of([code_points(c) for c in choices])
    asked = [code_points(q) for q in queries]
    found: list[tuple[int, float]] = [(-1, -1.0)] * len(asked)
    if not blocks:
        return found
    widest = max(b.words * len(b.at) for b in blocks)
    size = max(1, BATCH_WORDS // widest)
    order = np.argsort([len(q) for q in asked], kind="stable")
    for start in range(0, len(order), size):
        batch = order[start : start + size]
        n = np.array([len(asked[i]) for i in batch], dtype=np.int64)[:, None]
        bounds = [
            (2.0 * np.minimum(b.lengths, n) / np.maximum(b.lengths + n, 1)).max(axis=1) for b in blocks
        ]
        for number in sorted(range(len(blocks)), key=lambda i: -float(bounds[i].max())):
            block = blocks[number]
            best = np.array([found[i][1] for i in batch])
            rows = np.flatnonzero(bounds[number] >= best)
            if not len(rows):
                continue
            shared = block.common_subsequences([asked[batch[r]] for r in rows])
            scores = 2.0 * shared / np.maximum(block.lengths + n[rows], 1)
            for row, values in zip(rows, scores):
                top = float(values.max())
                at, before = found[batch[row]]
                if top < before:
                    continue
                same = [int(block.at[i]) for i in np.flatnonzero(values == top)]
                if top == before:
                    same.append(at)
                found[batch[row]] = (min(same, key=labels.__getitem__), top)
    return found


def best_both_ways(a: list[str], b: list[str], labels_a: list[str], labels_b: list[str], settled_a, settled_b):
    """For every text of `a` the index and similarity of the most similar one of `b`, and the reverse.

    As `best_in` in both directions, but a common subsequence is found once for both. Settled texts get no result, but
    are choices of the others. Pairs are left out in whole rows of a block, where neither text can gain.
    """
    rank_a, rank_b = (np.argsort(np.array(sorted(range(len(x)), key=x.__getitem__), np.int64)) for x in (labels_a, labels_b))
    # Similarity and the rank of the label, which ties go to.
    top_a, top_b = (np.where(np.array(s, bool), 2.0, -1.0) for s in (settled_a, settled_b))
    first_a, first_b = np.full(len(a), len(b)), np.full(len(b), len(a))
    blocks, asked = blocks_of([code_points(x) for x in b]), [code_points(x) for x in a]
    lengths = np.array([len(x) for x in asked], dtype=np.int64)
    size = max(1, BATCH_WORDS // max((x.words * len(x.at) for x in blocks), default=1))
    order = np.argsort(lengths, kind="stable")
    for start in range(0, len(order), size):
        batch = order[start : start + size]
        n = lengths[batch][:, None]
        bounds = [2.0 * np.minimum(x.lengths, n) / np.maximum(x.lengths + n, 1) for x in blocks]
        for number in sorted(range(len(blocks)), key=lambda i: -float(bounds[i].max())):
            block, at = blocks[number], blocks[number].at
            rows = np.flatnonzero((bounds[number] >= np.minimum(top_a[batch][:, None], top_b[at])).any(axis=1))
            if not len(rows):
                continue
            shared = block.common_subsequences([asked[i] for i in batch[rows]])
            scores = 2.0 * shared / np.maximum(block.lengths + n[rows], 1)
            _better(top_a, first_a, batch[rows], scores, rank_b[at])
            _better(top_b, first_b, at, scores.T, rank_a[batch[rows]])
    by_rank_a, by_rank_b = np.argsort(rank_a), np.argsort(rank_b)
    forth = [(int(by_rank_b[r]), float(t)) if r < len(b) else (-1, -1.0) for r, t in zip(first_a, top_a)]
    back = [(int(by_rank_a[r]), float(t)) if r < len(a) else (-1, -1.0) for r, t in zip(first_b, top_b)]
    return forth, back


def _better(top: np.ndarray, first: np.ndarray, at: np.ndarray, scores: np.ndarray, ranks: np.ndarray) -> None:
    """Move the texts `at` on to better scores (a row each), and at equal ones to the smallest rank."""
    best = scores.max(axis=1)
    rank = np.where(scores == best[:, None], ranks, np.iinfo(np.int64).max).min(axis=1)
    rank = np.where(best == top[at], np.minimum(rank, first[at]), rank)
    gained = best >= top[at]
    top[at[gained]], first[at[gained]] = best[gained], rank[gained]
