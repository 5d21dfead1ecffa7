"""Text columns: lengths, words, n-grams, phrase hits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of two or more letters, digits or underscores; one-letter words do not count.
WORD_PATTERN = r"([\p{L}\p{N}_]{2,})"


def piece_count(text: Column) -> Column:
    """Number of pieces between single spaces; empty pieces count, so "" has one."""
    return F.array_size(F.split(text, " ", -1))


def words(text: Column) -> Column:
    """Lower-cased words of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(1))


def word_ngrams(tokens: Column, n: int) -> Column:
    """All overlapping n-grams of a word array, each joined by one space."""
    grams = tokens
    for size in range(2, n + 1):
        left = F.greatest(F.size(tokens) - F.lit(size - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), left),
            F.slice(tokens, F.lit(size), left),
            lambda head, word: F.concat(head, F.lit(" "), word),
        )
    return grams


def ngrams_of_sizes(tokens: Column, sizes: Iterable[int]) -> Column:
    """The n-grams of every wanted size in one array. `tokens` should be a plain column."""
    parts = [word_ngrams(tokens, n) for n in sorted(set(sizes))]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def spaced_words(text: Column) -> Column:
    """The words joined by single spaces, with one at each end, ready for `has_phrase`."""
    return F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))


def has_phrase(spaced: Column, phrase: str) -> Column:
    """Whether a word n-gram occurs; `spaced` comes from `spaced_words`."""
    return spaced.contains(f" {phrase} ")


def substring_hits(text: Column, phrase: str) -> Column:
    """Non-overlapping occurrences of a phrase as a plain substring."""
    removed = F.length(F.replace(text, F.lit(phrase), F.lit("")))
    return F.floor((F.length(text) - removed) / F.lit(len(phrase))).cast("long")


def phrase_hits(text: Column, phrases: Iterable[str]) -> Column:
    """Sum of `substring_hits`; a phrase listed twice counts twice."""
    total = F.lit(0).cast("long")
    for phrase in phrases:
        total = total + substring_hits(text, phrase)
    return total


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def mentions_any(text: Column, phrases: Iterable[str]) -> Column:
    """Whether any of the word n-grams occurs in a text.

    The words are put into a one-element array and tested there, so they are made once per row however
    many phrases there are and wherever the optimizer moves the test.
    """

    def any_of(spaced):
        found = F.lit(False)
        for phrase in phrases:
            found = found | has_phrase(spaced, phrase)
        return found

    return F.exists(F.array(spaced_words(text)), any_of)
