"""Small dictionaries whose spellings occur in the test documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.plans.tables import SQL_ARTICLES, rows, sql_values

# Dictionary of the test tables (kind, id, spelling).
# `ez-zor` and `x y` can never match: words split at the hyphen and one-letter words do not count.
DICTIONARY = [
    ("keyword", "cv_the", "the"),
    ("keyword", "cv_of_the", "of the"),
    ("keyword", "eci_und", "und"),
    ("keyword", "eci_que_des", "que"),
    ("keyword", "eci_que_des", "des"),
    ("keyword", "fc_in_to", "in to"),
    ("keyword", "fc_hyphen", "ez-zor"),
    ("location", "xa", "la"),
    ("location", "xa_01", "le"),
    ("location", "xa_01_1", "der"),
    ("location", "xa_01_1", "die"),
    ("location", "xb", "with"),
    ("location", "xb_01", "by"),
    ("location", "xb_00_0", "x y"),
]
KEYWORD_IDS = ["cv_the", "cv_of_the", "eci_und", "eci_que_des", "fc_in_to", "fc_hyphen"]
LOCATION_IDS = ["xa", "xa_01", "xa_01_1", "xb", "xb_01", "xb_00_0"]
CATEGORIES = ["cv", "eci", "fc"]
COUNTRIES = ["xa", "xb"]
PAYWALL_PHRASES = ["the", "license", "and the", "and the"]


def dictionary(spark: SparkSession) -> DataFrame:
    return rows(spark, "kind, entity_id, variant", DICTIONARY)


# The same steps in SQL: words, n-grams of one and two words, hits, per-article ids.
SQL_MENTIONS = f"""dict(kind, entity_id, variant) AS (VALUES {sql_values(DICTIONARY)}),
{SQL_ARTICLES},
worded AS (
  SELECT article_id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM articles),
grams AS (
  SELECT article_id, unnest(w) AS variant FROM worded
  UNION ALL
  SELECT article_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
  FROM worded WHERE len(w) >= 2),
mentions AS (
  SELECT article_id, date, lang, source, kind, entity_id, count(*) AS n
  FROM grams JOIN dict USING (variant) JOIN articles USING (article_id)
  GROUP BY ALL),
loc AS (SELECT article_id, date, lang, entity_id AS location FROM mentions WHERE kind = 'location'),
kw AS (SELECT article_id, date, lang, source, entity_id AS keyword, split_part(entity_id, '_', 1) AS category
       FROM mentions WHERE kind = 'keyword'),
any_kw AS (SELECT DISTINCT article_id FROM kw)"""


def _sql_daily(by: str) -> str:
    cells = "".join(
        f",\n  CAST(count(DISTINCT CASE WHEN category = '{c}' THEN article_id END) AS BIGINT) AS {c}"
        + "".join(
            f",\n  CAST(count(DISTINCT CASE WHEN keyword = '{k}' THEN article_id END) AS BIGINT) AS {k}"
            for k in KEYWORD_IDS
            if k.split("_")[0] == c
        )
        for c in CATEGORIES
    )
    places = ", ".join(f"('{i}')" for i in LOCATION_IDS)
    return f"""places(location) AS (VALUES {places}),
spine AS (SELECT {by}, location FROM (SELECT DISTINCT {by} FROM articles) CROSS JOIN places),
pairs AS (SELECT loc.article_id, loc.date, loc.lang, loc.location, kw.keyword, kw.category
          FROM loc LEFT JOIN kw USING (article_id)),
daily AS (
  SELECT {by}, location,
  CAST(count(DISTINCT article_id) AS BIGINT) AS count_articles,
  CAST(len(string_split(location, '_')) - 1 AS INTEGER) AS admin_level{cells},
  CAST(count(DISTINCT CASE WHEN keyword IS NOT NULL THEN article_id END) AS BIGINT) AS kw
  FROM spine LEFT JOIN pairs USING ({by}, location)
  GROUP BY {by}, location)"""


SQL_DAILY = SQL_MENTIONS + ",\n" + _sql_daily("date")
SQL_DAILY_LANG = SQL_MENTIONS + ",\n" + _sql_daily("date, lang")
