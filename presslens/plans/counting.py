"""Counting dictionary spellings and the daily tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import daily as D
from presslens.operators import mentions as M
from presslens.plans import fixtures as X
from presslens.plans.registry import query
from presslens.plans.tables import articles


def daily_sets(spark, directory, keep=("date",)):
    """Per-article id sets of the test dictionary."""
    return M.entity_sets(articles(spark, directory), X.dictionary(spark), keep)


def daily_table(spark, directory):
    """The published daily table of the test documents."""
    return D.daily_summary(
        articles(spark, directory), daily_sets(spark, directory), X.KEYWORD_IDS, X.LOCATION_IDS
    )


@query(
    "article_lengths",
    """SELECT doc_id AS article_id, CAST(length(text) AS INTEGER) AS body_len,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS body_len_str FROM documents""",
)
def article_lengths(spark, directory):
    return M.article_lengths(articles(spark, directory)).select(
        "article_id", "body_len", "body_len_str"
    )


@query(
    "token_counts",
    """SELECT token, count(*) AS n
       FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS token FROM documents)
       GROUP BY token""",
)
def token_counts(spark, directory):
    return M.token_counts(articles(spark, directory))


@query(
    "ngram_mentions",
    f"""WITH {X.SQL_MENTIONS}
    SELECT article_id, variant, count(*) AS n
    FROM grams WHERE variant IN (SELECT variant FROM dict) GROUP BY article_id, variant""",
)
def ngram_mentions(spark, directory):
    return M.spelling_counts(articles(spark, directory), X.dictionary(spark))


@query(
    "dictionary_rollup",
    f"WITH {X.SQL_MENTIONS} SELECT article_id, kind, entity_id, n FROM mentions",
)
def dictionary_rollup(spark, directory):
    return M.mentions(articles(spark, directory), X.dictionary(spark))


@query(
    "kw_all_per_article",
    f"""WITH {X.SQL_MENTIONS}
    SELECT article_id, CAST(sum(n) AS BIGINT) AS kw_all FROM mentions WHERE kind = 'keyword'
    GROUP BY article_id""",
)
def kw_all_per_article(spark, directory):
    return M.keyword_totals(M.mentions(articles(spark, directory), X.dictionary(spark)))


_WIDE_SQL = ", ".join(
    f"CAST(coalesce(sum(n) FILTER (entity_id = '{i}'), 0) AS BIGINT) AS {i}"
    for i in X.KEYWORD_IDS + X.LOCATION_IDS
)


@query(
    "counts_per_article_wide",
    f"""WITH {X.SQL_MENTIONS}
    SELECT a.article_id, a.date, a.lang, a.source, CAST(length(a.body) AS INTEGER) AS body_len,
      CAST(len(string_split(a.body, ' ')) AS INTEGER) AS body_len_str, {_WIDE_SQL},
      CAST(coalesce(sum(n) FILTER (kind = 'keyword'), 0) AS BIGINT) AS kw_all
    FROM articles a LEFT JOIN mentions m ON m.article_id = a.article_id
    GROUP BY a.article_id, a.date, a.lang, a.source, a.body""",
)
def counts_per_article_wide(spark, directory):
    found = articles(spark, directory)
    counted = M.mentions(found, X.dictionary(spark))
    heads = M.article_lengths(found).drop("title", "body")
    return M.counts_per_article(heads, counted, X.KEYWORD_IDS + X.LOCATION_IDS)


@query(
    "daily_location_counts",
    f"""WITH {X.SQL_MENTIONS}
    SELECT date, location, count(DISTINCT article_id) AS count_articles,
      CAST(len(string_split(location, '_')) - 1 AS INTEGER) AS admin_level
    FROM loc GROUP BY date, location""",
)
def daily_location_counts(spark, directory):
    counted = D.location_counts(daily_sets(spark, directory))
    return counted.withColumn("admin_level", D.level_of(F.col("location")))


@query(
    "daily_category_counts",
    f"""WITH {X.SQL_MENTIONS}
    SELECT date, location, category AS measure, count(DISTINCT article_id) AS n
    FROM loc JOIN (SELECT article_id, category FROM kw UNION ALL SELECT article_id, 'kw' FROM any_kw)
      USING (article_id)
    GROUP BY date, location, category""",
)
def daily_category_counts(spark, directory):
    return D.category_counts(daily_sets(spark, directory))


@query(
    "daily_keyword_counts",
    f"""WITH {X.SQL_MENTIONS}
    SELECT loc.date, location, keyword AS measure, count(DISTINCT article_id) AS n
    FROM loc JOIN kw USING (article_id) GROUP BY loc.date, location, keyword""",
)
def daily_keyword_counts(spark, directory):
    return D.keyword_counts(daily_sets(spark, directory))


@query(
    "daily_spine_zero_fill",
    f"WITH {X.SQL_DAILY} SELECT date, location, count_articles FROM daily",
)
def daily_spine_zero_fill(spark, directory):
    counted = D.location_counts(daily_sets(spark, directory)).select(
        "date", "location", F.lit(D.ARTICLES).alias("measure"), F.col(D.ARTICLES).alias("n")
    )
    return D.zero_filled(articles(spark, directory), counted, X.LOCATION_IDS, [D.ARTICLES])


@query("daily_summary", f"WITH {X.SQL_DAILY} SELECT *, 'English' AS language FROM daily")
def daily_summary(spark, directory):
    return daily_table(spark, directory)


@query(
    "daily_summary_bilingual",
    f"""WITH {X.SQL_DAILY_LANG}
    SELECT * EXCLUDE (lang), CASE lang WHEN 'en' THEN 'English' ELSE 'French' END AS language
    FROM daily WHERE lang IN ('en', 'fr')""",
)
def daily_summary_bilingual(spark, directory):
    return D.daily_summary(
        articles(spark, directory),
        daily_sets(spark, directory, ("date", "lang")),
        X.KEYWORD_IDS,
        X.LOCATION_IDS,
        languages={"en": "English", "fr": "French"},
    )


_PAYWALL_SQL = " + ".join(
    f"CAST((length(lower(text)) - length(replace(lower(text), '{p}', ''))) // {len(p)} AS BIGINT)"
    for p in X.PAYWALL_PHRASES
)
SQL_PAYWALL = f"""scored AS (
  SELECT doc_id AS article_id, source, {_PAYWALL_SQL} AS paywall_hits,
    CAST(len(string_split(text, ' ')) AS INTEGER) AS pieces FROM documents),
paywall AS (
  SELECT *, CAST(paywall_hits AS DOUBLE) / CAST(pieces AS DOUBLE) AS paywall_score FROM scored)"""


def paywall_table(spark, directory):
    found = articles(spark, directory).select("article_id", "source", "body")
    return M.paywall_scores(found, X.PAYWALL_PHRASES).drop("body")


@query("paywall_score", f"WITH {SQL_PAYWALL} SELECT * FROM paywall")
def paywall_score(spark, directory):
    return paywall_table(spark, directory)


@query(
    "sentence_explode",
    """SELECT doc_id AS article_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS position,
         unnest(parts) AS sentence
       FROM (SELECT doc_id, string_split(text, '.') AS parts FROM documents)""",
)
def sentence_explode(spark, directory):
    return M.sentences(articles(spark, directory))
