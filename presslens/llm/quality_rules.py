"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Every word gives two hashed features: its last three characters, and the last two characters of a word
with the first two of the next (n-grams at word ends, which say how a text is written rather than what
about). Two multinomials over `BUCKETS` buckets are counted, one over the trusted documents and one over
all documents. The weight of a bucket is the log ratio of its two smoothed shares, kept as a whole number
of thousandths of a nat, so that a document's sum does not depend on the order of addition. A document
is kept if its mean weight reaches `THRESHOLD` and the base rules hold. All of it is column expressions.

Defined results: a null, empty or blank text has no words, fails the base rules and scores 0; null ids are
scored like any other; repeated rows are counted and scored once each; without trusted documents every
weight is 0; an empty table gives an empty result. Only the named columns are read, so further columns of
any name do no harm. Repeated three-word windows are found by 64-bit hashes of their words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import unused, words_of

BUCKETS = 1 << 14
# Added to the counts of both multinomials at the target's scale; pulls rare buckets to a weight of 0.
SMOOTHING = 3.0
# Mean weight in thousandths of a nat below which a document is rejected.
THRESHOLD = -600
# The trusted multinomial is fitted on at most so many trusted documents, those with the smallest hashes.
TRUSTED = 20_000
SYMBOLS = r"[^#*$%&|<>]+"


def features(words: Column) -> Column:
    """Bucket numbers of the hashed n-grams of a word array."""
    bucket = lambda gram: F.crc32(gram.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    ends = F.transform(words, lambda w: bucket(F.concat(F.lit("u"), F.right(w, F.lit(3)))))
    across = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: bucket(
            F.concat(F.right(w, F.lit(2)), F.lit(" "), F.left(F.get(words, i + 1), F.lit(2)))
        ),
    )
    return F.concat(ends, across)


def trusted_sample(labels: DataFrame, id_column: str = "doc_id", most: int = TRUSTED) -> DataFrame:
    """At most `most` ids of documents labelled good: those with the smallest hashes."""
    good = labels.where((F.col("quality") == 1) & F.col(id_column).isNotNull()).select(id_column).distinct()
    return good.orderBy(F.xxhash64(id_column), id_column).limit(most)


def fit_weights(
    docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> list[int]:
    """One whole-number weight per bucket, from all of `docs` and those of them whose id is trusted.

    `trusted` has at most `TRUSTED` rows and is broadcast. The counts are combined in each task, so a
    task shuffles at most `BUCKETS` rows and the driver gets that many.
    """
    listed = F.broadcast(trusted.select(F.col(id_column).alias("_id"), F.lit(1).alias("_trusted")))
    rows = docs.select(F.col(id_column).alias("_id"), words_of(F.col(text_column)).alias("_words"))
    grams = rows.join(listed, "_id", "left").select(
        F.coalesce("_trusted", F.lit(0)).alias("_trusted"), F.explode(features(F.col("_words"))).alias("_bucket")
    )
    counted = grams.groupBy("_bucket").agg(F.count("*").alias("raw"), F.sum("_trusted").alias("target")).collect()
    raw, target = sum(r["raw"] for r in counted), sum(r["target"] for r in counted)
    weights = [0] * BUCKETS
    for r in counted if target else []:
        ratio = (r["target"] + SMOOTHING) / (r["raw"] * target / raw + SMOOTHING)
        weights[r["_bucket"]] = round(1000 * math.log(ratio))
    return weights


def _repeated(words: Column, sorted_windows: Column) -> Column:
    """Words in windows that another window of the text equals; windows are (hash, place), sorted."""
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(
        sorted_windows,
        lambda w, i: same(w, F.get(sorted_windows, i + 1))
        | same(w, F.get(sorted_windows, F.when(i > 0, i - 1))),
    )
    places = F.sort_array(F.transform(twice, lambda w: w["p"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    step = lambda a, p: F.struct(
        (p + 3).alias("end"), (a["total"] + F.least(F.lit(3), p + 3 - a["end"])).alias("total")
    )
    return F.aggregate(places, start, step, lambda a: a["total"].cast("long"))


def with_quality(docs: DataFrame, weights: list[int], text_column: str = "text") -> DataFrame:
    """Add the column `quality`, a struct of all counts, the score and the verdict, to each row.

    An existing column of that name is kept; the struct then gets the next free name, the last column. Its field
    `row` numbers the rows: a filter that names it is not pushed below the counts, which would be made twice.
    """
    name, w, s, f, t = (unused(docs, n) for n in ("quality", "_words", "_windows", "_features", "_text"))
    text, words = F.col(f"`{t}`"), F.col(f"`{w}`")
    window = lambda x, i: F.struct(
        F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")
    )
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    cut = docs.withColumn(t, F.coalesce(F.col(text_column), F.lit(""))).withColumn(w, words_of(text))
    cut = cut.withColumn(f, features(words)).withColumn(s, F.sort_array(F.transform(first, window)))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")) != "")
    # Folded into one constant by the optimizer.
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    total = F.aggregate(F.col(f"`{f}`"), F.lit(0).cast("long"), lambda a, x: a + F.get(table, x))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated(words, F.col(f"`{s}`")).alias("n_repeat_words"),
        total.alias("total"),
        F.size(F.col(f"`{f}`")).alias("n_features"),
        F.monotonically_increasing_id().alias("row"),
    )
    q = F.col(f"`{name}`")
    failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    judged = cut.withColumn(name, counts).withColumn(
        name,
        q.withField("base_failed", failed)
        .withField("score", F.when(q["n_features"] > 0, q["total"] / q["n_features"] / 1000).otherwise(F.lit(0.0)))
        .withField("kept", ~failed & (q["total"] >= F.lit(THRESHOLD) * q["n_features"])),
    )
    return judged.drop(w, s, f, t)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) its counts, score and verdict."""
    rows = docs.select("doc_id", "text")
    judged = with_quality(rows, fit_weights(rows, trusted_sample(labels)))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept score".split()
    return judged.select("doc_id", *[F.col("quality")[n].alias(n) for n in names])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    judged = with_quality(docs, fit_weights(docs, trusted_sample(labels)))
    name = judged.columns[-1]
    q = F.col(f"`{name}`")
    return judged.where(q["kept"] & (q["row"] >= 0)).drop(name)
