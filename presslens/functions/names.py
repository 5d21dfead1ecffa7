"""Name, id and address columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading articles, each removed at most once, in this order.
ARTICLES = ["al-", "al ", "ar-", "ar ", "as-", "as ", "el-", "el ", "ath-", "ath ", "az-", "az ", "an-", "an "]

# Unit words deleted from place names.
UNIT_WORDS = ["district", "province", "governorate", "department", "markaz"]


def strip_articles(name: Column, articles: list[str] = ARTICLES) -> Column:
    """Remove leading articles one after the other, so one name can lose several."""
    return reduce(lambda c, a: F.regexp_replace(c, f"^{a}", ""), articles, name)


def clean_name(name: Column) -> Column:
    """Lower case, doubled spaces made single, unit words deleted, trimmed, articles stripped."""
    plain = F.replace(F.lower(name), F.lit("  "), F.lit(" "))
    for word in UNIT_WORDS:
        plain = F.replace(plain, F.lit(word), F.lit(""))
    return strip_articles(F.trim(plain))


def clean_names(names: Column) -> Column:
    """Clean an array of names: Latin ones only, cleaned, the empty and repeated ones dropped."""
    latin = F.filter(names, lambda n: n.rlike("[a-zA-Z]"))
    return F.array_distinct(F.filter(F.transform(latin, clean_name), lambda n: n != ""))


def prune_supersets(names: Column) -> Column:
    """Drop a name whose words are a proper superset of the words of another name."""

    def word_set(name):
        return F.array_distinct(F.split(name, " ", -1))

    def contains_other(name):
        return F.exists(
            names,
            lambda other: (F.size(F.array_except(word_set(other), word_set(name))) == 0)
            & (F.size(word_set(other)) < F.size(word_set(name))),
        )

    return F.filter(names, lambda name: ~contains_other(name))


def strip_phrases(name: Column, phrases: list[str]) -> Column:
    """Delete phrases, then bracketed parts, and trim."""
    plain = reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), phrases, name)
    return F.trim(F.regexp_replace(plain, r"\(.*?\)", ""))


def bracket_alias(name: Column) -> Column:
    """`Name[alias]` to the alias, any other name to itself."""
    return F.replace(F.element_at(F.split(name, r"\[", -1), -1), F.lit("]"), F.lit(""))


def capitalize_except_and(name: Column) -> Column:
    """Capitalise every space-separated word but `and`."""
    words = F.transform(
        F.split(name, " ", -1),
        lambda w: F.when(w == "and", w).otherwise(
            F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
        ),
    )
    return F.array_join(words, " ")


def domain_of(url: Column) -> Column:
    """Host of an address, lower-cased, without scheme and `www.`."""
    bare = reduce(
        lambda c, p: F.replace(c, F.lit(p), F.lit("")), ["https://", "http://", "www."], url
    )
    return F.lower(F.substring_index(bare, "/", 1))


def without_number_suffix(title: Column) -> Column:
    """Drop the ` (2)` that tells equal titles apart."""
    return F.regexp_replace(title, r"\s*\(\d+\)", "")


def without_all_sources(source: Column) -> Column:
    """Drop the ` - all sources` that a provider adds to the name of a group."""
    return F.replace(source, F.lit(" - all sources"), F.lit(""))


def python_literal_to_json(text: Column) -> Column:
    """Rewrite the bare words of a printed Python struct so that `from_json` can read it.

    The text is cut into quoted strings and what lies between them; strings are left as they are.
    """
    swaps = {"None": "null", "True": "true", "False": "false"}
    pieces = F.regexp_extract_all(text, F.lit(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+|['"]"""), F.lit(0))
    rewritten = lambda c: reduce(lambda x, w: F.regexp_replace(x, rf"\b{w}\b", swaps[w]), swaps, c)
    bare = lambda c: F.when(c.startswith("'") | c.startswith('"'), c).otherwise(rewritten(c))
    return F.array_join(F.transform(pieces, bare), "")
