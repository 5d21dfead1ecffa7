"""Counting dictionary spellings in article bodies.

The core model is long: one row per article and dictionary id that occurs in it. Articles stay on
the executor that scanned them until only the hits are left, and the hits are counted map-side before
the one shuffle by article.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as T
from presslens.operators.sizing import BROADCAST_ROWS, spread

# Bits of the filter of first words per spelling, and the most bits it may have: beyond them it passes more
# words on, which the join then drops.
HEAD_BITS, MOST_BITS = 16, 1 << 24


def article_lengths(articles: DataFrame, body: str = "body") -> DataFrame:
    """Add `body_len` (characters) and `body_len_str` (pieces), taken before lower-casing."""
    return articles.withColumns(
        {"body_len": F.length(body), "body_len_str": T.piece_count(F.col(body))}
    )


def tokenized_variants(variants: DataFrame) -> DataFrame:
    """Spellings cut into words as bodies are, so that `ez-zor` can match `ez zor`."""
    spelled = F.array_join(T.words(F.col("variant")), " ")
    return variants.withColumn("variant", spelled).where("variant <> ''").distinct()


def vocabulary(variants: DataFrame) -> DataFrame:
    """Distinct spellings and the number of pieces of each."""
    return variants.select("variant", T.piece_count(F.col("variant")).alias("pieces")).distinct()


def vocabulary_stats(variants: DataFrame) -> DataFrame:
    """Number of spellings and size of the longest one."""
    return vocabulary(variants).agg(
        F.count("*").alias("n_spellings"), F.max("pieces").alias("max_ngram")
    )


def worded(articles: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """The `keep` columns and the words of every body."""
    return spread(articles.select(*keep, body)).select(*keep, T.words(F.col(body)).alias("_words"))


def exploded_ngrams(
    articles: DataFrame, sizes: list[int], keep: list[str], body: str = "body"
) -> DataFrame:
    """One row per n-gram of every wanted size, with the `keep` columns."""
    grams = T.ngrams_of_sizes(F.col("_words"), sizes)
    return worded(articles, keep, body).select(*keep, F.explode(grams).alias("variant"))


def token_counts(articles: DataFrame, body: str = "body") -> DataFrame:
    """Frequency of every word over all bodies."""
    return (
        exploded_ngrams(articles, [1], [], body)
        .groupBy(F.col("variant").alias("token"))
        .agg(F.count("*").alias("n"))
    )


def first_words(names: DataFrame) -> DataFrame:
    """The first word of every spelling and the sizes of the spellings that begin with it."""
    pieces = F.split(F.col("variant"), " ", -1)
    parts = names.select(F.get(pieces, F.lit(0)).alias("_head"), F.size(pieces).alias("_size"))
    return parts.groupBy("_head").agg(F.array_sort(F.collect_set("_size")).alias("_sizes"))


def _head_bit(word, bits: int):
    return F.pmod(F.xxhash64(word), F.lit(bits).cast("long"))


def head_filter(variants: DataFrame, bits: int) -> DataFrame:
    """One row: an array of longs with a bit for the hash of every first word."""
    at = _head_bit(F.split_part("variant", F.lit(" "), F.lit(1)), bits)
    bit = F.expr("shiftleft(1L, CAST(_at % 64 AS INT))")
    held = variants.select(at.alias("_at")).select(F.shiftright("_at", 6).alias("_place"), bit.alias("_bits"))
    # Zero rows for all places, so that a place is an index.
    spine = variants.sparkSession.range(bits // 64).select(F.col("id").alias("_place"), F.lit(0).cast("long").alias("_bits"))
    cells = held.unionByName(spine).groupBy("_place").agg(F.bit_or("_bits").alias("_bits"))
    laid = F.array_sort(F.collect_list(F.struct("_place", "_bits")))
    return cells.agg(F.transform(laid, lambda cell: cell["_bits"]).alias("_filter"))


def spelling_hits(
    articles: DataFrame,
    variants: DataFrame,
    keep: list[str],
    body: str = "body",
    match: str = "exact",
    by_lang: bool = False,
) -> DataFrame:
    """One row per occurrence of a spelling and dictionary id it belongs to.

    Only words that may begin a spelling leave their row: a filter of bits, a scalar subquery, drops nearly all
    others. The words that follow come along, as many as the longest spelling has. The first words are
    joined to the sizes of the spellings that begin with them, and the n-grams of just these sizes to the spellings.
    Both sides are broadcast only when the counted rows of the dictionary allow it; the way is the same for all.
    `by_lang` uses the spellings of an article's own language only.
    """
    if match == "tokenized":
        variants = tokenized_variants(variants)
    # Null and empty spellings occur in no text.
    variants = variants.where("variant <> ''")
    keys = ["variant", "lang"] if by_lang else ["variant"]
    kept = list(dict.fromkeys([*keep, *keys[1:]]))
    names = variants.select(*keys, "kind", "entity_id").distinct()
    heads = first_words(names)
    size = variants.agg(F.count("*"), F.max(T.piece_count(F.col("variant")))).first()
    longest = size[1] or 1
    bits = 64
    while bits < min(HEAD_BITS * size[0], MOST_BITS):
        bits *= 2
    tokens = worded(articles, kept, body).withColumn("_filter", head_filter(variants, bits).scalar())

    def may_begin(word):
        at = _head_bit(word, bits)
        return F.getbit(F.get(F.col("_filter"), F.shiftright(at, 6).cast("int")), at % 64) == 1

    words = F.col("_words")
    places = F.filter(F.transform(words, lambda w, i: F.when(may_begin(w), i)), lambda i: i.isNotNull())
    windows = F.transform(places, lambda i: F.slice(words, i + 1, longest))
    starts = tokens.select(*kept, F.explode(windows).alias("_window"))
    starts = starts.withColumn("_head", F.get("_window", F.lit(0)))
    if size[0] <= BROADCAST_ROWS:
        heads, names = F.broadcast(heads), F.broadcast(names)
    begun = starts.join(heads, "_head")
    fitting = F.filter("_sizes", lambda n: n <= F.size("_window"))
    grams = F.transform(fitting, lambda n: F.array_join(F.slice("_window", F.lit(1), n), " "))
    hits = begun.select(*kept, F.explode(grams).alias("variant"))
    return hits.join(names, keys)


def spelling_counts(articles: DataFrame, variants: DataFrame, **options) -> DataFrame:
    """Occurrences per article and spelling; a spelling of two ids is counted once."""
    names = variants.select("variant", F.lit("").alias("kind"), F.lit("").alias("entity_id"))
    hits = spelling_hits(articles, names, ["article_id"], **options)
    return hits.groupBy("article_id", "variant").agg(F.count("*").alias("n"))


def mentions(
    articles: DataFrame, variants: DataFrame, keep: tuple[str, ...] = (), **options
) -> DataFrame:
    """Occurrences per article and id, spellings summed up; `keep` adds article columns."""
    kept = ["article_id", *keep]
    hits = spelling_hits(articles, variants, kept, **options)
    return hits.groupBy(*kept, "kind", "entity_id").agg(F.count("*").alias("n"))


def keyword_totals(counted: DataFrame) -> DataFrame:
    """`kw_all`: occurrences of all keyword ids per article."""
    keywords = counted.where("kind = 'keyword'")
    return keywords.groupBy("article_id").agg(F.sum("n").alias("kw_all"))


def counts_per_article(articles: DataFrame, counted: DataFrame, ids: list[str]) -> DataFrame:
    """Wide table: article columns, one zero-filled column per id, and `kw_all`.

    `counted` is brought together by article once; the sum of the keywords is one more column of the same pivot.
    """
    cells = F.array(F.col("entity_id"), F.when(F.col("kind") == "keyword", "kw_all"))
    long = counted.repartition("article_id").select("article_id", F.explode(F.array_compact(cells)).alias("_id"), "n")
    wide = long.groupBy("article_id").pivot("_id", [*ids, "kw_all"]).agg(F.sum("n").cast("long"))
    return articles.join(wide, "article_id", "left").fillna(0, [*ids, "kw_all"])


def entity_sets(articles: DataFrame, variants: DataFrame, keep: tuple[str, ...], **options):
    """One row per article with any hit: the sets of its locations and of its keywords.

    Each set is bounded by the dictionary. Articles with neither have no row.
    """
    kept = ["article_id", *keep]
    hits = spelling_hits(articles, variants, kept, **options)

    def ids_of(kind):
        return F.collect_set(F.when(F.col("kind") == kind, F.col("entity_id")))

    return hits.groupBy(*kept).agg(
        ids_of("location").alias("locations"), ids_of("keyword").alias("keywords")
    )


def category_of(entity_id):
    """Category of a keyword id: the text before its first underscore."""
    return F.split_part(entity_id, F.lit("_"), F.lit(1))


def category_map(variants: DataFrame) -> DataFrame:
    """(category, keyword id) pairs, with the extra category `kw` that holds `kw_all`."""
    keywords = variants.where("kind = 'keyword'").select("entity_id").distinct()
    pairs = keywords.select(category_of(F.col("entity_id")).alias("category"), "entity_id")
    total = variants.sparkSession.sql("SELECT 'kw' AS category, 'kw_all' AS entity_id")
    return pairs.unionByName(total)


def name_word_frequency(names: DataFrame, column: str) -> DataFrame:
    """How often each space-separated word occurs in a name column."""
    parts = names.where(F.col(column).isNotNull()).select(F.explode(F.split(column, " ", -1)).alias("word"))
    return parts.groupBy("word").agg(F.count("*").alias("n"))


def sentences(articles: DataFrame, body: str = "body") -> DataFrame:
    """One row per piece between full stops, numbered from zero."""
    pieces = F.posexplode(F.split(body, r"\.", -1)).alias("position", "sentence")
    return articles.select("article_id", pieces)


def paywall_scores(articles: DataFrame, phrases: list[str], body: str = "body") -> DataFrame:
    """Paywall phrase hits, pieces, and hits per piece of every article."""
    lowered = spread(articles).withColumn("_lower", F.lower(body))
    scored = lowered.withColumns(
        {
            "paywall_hits": T.phrase_hits(F.col("_lower"), phrases),
            "pieces": T.piece_count(F.col(body)),
        }
    )
    return scored.withColumn(
        "paywall_score", F.col("paywall_hits").cast("double") / F.col("pieces").cast("double")
    ).drop("_lower")
