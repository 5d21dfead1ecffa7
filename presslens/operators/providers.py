"""News sources of two providers: frequencies, matches, ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.names import without_all_sources, without_number_suffix
from presslens.operators import ranking
from presslens.operators.rollups import share_over


def source_frequency(df: DataFrame, keys: list[str], weight: str, name: str) -> DataFrame:
    """Summed weight per lower-cased key pair; rows with a missing key are left out."""
    lowered = df.select(*[F.lower(k).alias(k) for k in keys], weight).dropna(subset=keys)
    return lowered.groupBy(*keys).agg(F.sum(weight).alias(name))


def number_repeated_titles(sources: DataFrame) -> DataFrame:
    """Titles that several addresses share become `title (1)`, `title (2)`, … by falling frequency.

    A title may be shared by very many addresses, so it is numbered in ranges of frequency and address.
    """
    repeated = sources.groupBy("title").agg(F.count("*").alias("_shared"))
    marked = sources.join(repeated, "title")
    numbered = ranking.number_rows(marked, ["title"], [-F.col("frequency"), F.col("uri")])
    suffixed = F.concat("title", F.lit(" ("), F.col("number"), F.lit(")"))
    title = F.when(F.col("_shared") > 1, suffixed).otherwise(F.col("title"))
    return numbered.withColumn("title", title).drop("_shared", "number")


def top_labelled(sources: DataFrame, k: int = 10, longest: int = 45) -> DataFrame:
    """The k most frequent sources; an address stands in for a title that is too long to show."""
    first = sources.orderBy(F.desc("frequency"), "title", "uri").limit(k)
    use_uri = (F.length("title") > longest) & F.col("uri").isNotNull()
    return first.withColumn("label", F.when(use_uri, F.col("uri")).otherwise(F.col("title")))


def flag_in(df: DataFrame, column: str, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add 1 where the value occurs among the keys of another table, else 0."""
    wanted = keys.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    marked = df.join(wanted, F.col(column) == F.col("_key"), "left")
    return marked.withColumn(flag, F.col("_key").isNotNull().cast("int")).drop("_key")


def match_sources(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flag the sources of each provider that the other has, by address, by name, by either.

    Provider a has (title, uri, frequency) with numbered titles, provider b (source, uri,
    document_count), where a name may say that it stands for all sources of a group.
    """
    b = b.withColumn("source", without_all_sources(F.col("source")))
    titles = a.withColumn("_plain", without_number_suffix(F.col("title")))
    left = flag_in(titles, "uri", b, "uri", "uri_match")
    left = flag_in(left, "_plain", b, "source", "title_match").drop("_plain")
    right = flag_in(b, "uri", a, "uri", "uri_match")
    right = flag_in(right, "source", titles, "_plain", "source_match")
    return (
        left.withColumn("matched", F.greatest("uri_match", "title_match")),
        right.withColumn("matched", F.greatest("uri_match", "source_match")),
    )


def overlap_share(matched: DataFrame, weight: str) -> DataFrame:
    """Sources and articles with and without a match, each with its share."""
    counted = matched.groupBy("matched").agg(
        F.count("*").alias("sources"), F.sum(weight).alias("articles")
    )
    # At most two rows are left, so their totals are taken in one task.
    whole = counted.withColumn("_all", F.lit(0))
    return whole.withColumns(
        {
            "source_share": share_over(whole, "sources", ["_all"]),
            "article_share": share_over(whole, "articles", ["_all"]),
        }
    ).drop("_all")


def join_ratings(sources: DataFrame, ratings: DataFrame) -> DataFrame:
    """Add the rating of the source's domain, null where there is none."""
    return sources.join(ratings, F.col("uri") == F.col("domain"), "left")


def rating_coverage(rated: DataFrame) -> DataFrame:
    """Sources without an address and without a rating."""
    return rated.agg(
        F.count("*").alias("sources"),
        F.count_if(F.col("uri").isNull()).alias("without_uri"),
        F.count_if(F.col("pc1").isNull()).alias("without_rating"),
    )


def compare_providers(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Stack the count tables of several providers, their keys prefixed with the provider."""
    stacked = None
    for prefix, counts in tables.items():
        joined = F.concat(F.lit(f"{prefix}_"), F.replace(key, F.lit(" "), F.lit("_")))
        part = counts.withColumn(key, joined)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def agreed_value(df: DataFrame, first: str, second: str, key: str, overrides: DataFrame) -> DataFrame:
    """Keep a looked-up value where two lookups agree; elsewhere take it from the overrides.

    `overrides` has the key and `override`; an override also replaces an agreed value.
    """
    joined = df.join(overrides, key, "left")
    agreed = F.when(F.col(first) == F.col(second), F.col(first))
    return joined.withColumn("uri", F.coalesce("override", agreed)).drop("override")
