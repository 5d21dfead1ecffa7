"""Roll-ups, shares, funnels and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions import dates as DT
from presslens.operators import mentions as M
from presslens.operators import rollups as R
from presslens.operators import stats as S
from presslens.plans import fixtures as X
from presslens.plans.counting import SQL_PAYWALL, daily_sets, daily_table, paywall_table
from presslens.plans.registry import query
from presslens.plans.tables import articles, table

_MEASURES = ["count_articles", *X.CATEGORIES, "kw"]
_SUMS = ", ".join(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS {m}" for m in _MEASURES)
_WEEKLY = f"""{X.SQL_DAILY},
weekly AS (
  SELECT location, admin_level, CAST(date_trunc('week', date) AS DATE) + 6 AS date, {_SUMS}
  FROM daily GROUP BY ALL)"""


def _weekly(spark, directory):
    return R.location_period_rollup(daily_table(spark, directory), "W", _MEASURES, ["language"])


@query(
    "location_weekly_rollup",
    f"WITH {_WEEKLY} SELECT *, 'English' AS language FROM weekly",
)
def location_weekly_rollup(spark, directory):
    return _weekly(spark, directory)


@query(
    "location_yearly_rollup",
    f"""WITH {X.SQL_DAILY}
    SELECT location, admin_level, make_date(CAST(year(date) AS INTEGER), 12, 31) AS date, {_SUMS},
      'English' AS language
    FROM daily GROUP BY location, admin_level, make_date(CAST(year(date) AS INTEGER), 12, 31)""",
)
def location_yearly_rollup(spark, directory):
    return R.location_period_rollup(daily_table(spark, directory), "Y", _MEASURES, ["language"])


_FUNNEL = {
    "articles_country": "l0",
    "articles_country_provinces": "l0 AND l1",
    "articles_provinces": "l1",
    "articles_country_districts": "l0 AND l2",
    "articles_districts": "l2",
}
_FUNNEL_SQL = ", ".join(
    f"count(*) FILTER ({c}) AS {n}, count(*) FILTER ({c} AND has_kw) AS {n}_keywords"
    for n, c in _FUNNEL.items()
)


@query(
    "mention_funnel",
    f"""WITH {X.SQL_MENTIONS},
    flags AS (
      SELECT article_id, split_part(location, '_', 1) AS country,
        bool_or(len(string_split(location, '_')) = 1) AS l0,
        bool_or(len(string_split(location, '_')) = 2) AS l1,
        bool_or(len(string_split(location, '_')) = 3) AS l2,
        article_id IN (SELECT article_id FROM any_kw) AS has_kw
      FROM loc GROUP BY article_id, split_part(location, '_', 1))
    SELECT country, {_FUNNEL_SQL} FROM flags GROUP BY country""",
)
def mention_funnel(spark, directory):
    return R.mention_funnel(daily_sets(spark, directory))


@query(
    "keyword_coverage",
    f"""WITH {X.SQL_MENTIONS}
    SELECT (SELECT count(*) FROM articles) AS articles,
           (SELECT count(*) FROM any_kw) AS articles_keywords""",
)
def keyword_coverage(spark, directory):
    return R.keyword_coverage(articles(spark, directory), daily_sets(spark, directory))


_TOTALS = f"""{X.SQL_DAILY},
totals AS (
  SELECT location, CAST(sum(count_articles) AS BIGINT) AS articles,
    CAST(sum(kw) AS BIGINT) AS articles_keywords,
    CAST(sum(count_articles) - sum(kw) AS BIGINT) AS articles_no_keywords
  FROM daily WHERE split_part(location, '_', 1) = 'xa' AND admin_level = 1 GROUP BY location)"""


@query("level_location_totals", f"WITH {_TOTALS} SELECT * FROM totals")
def level_location_totals(spark, directory):
    return R.location_totals(daily_table(spark, directory), "xa", 1)


@query(
    "level_location_summary",
    f"""WITH {_TOTALS}
    SELECT count(*) AS locations, count(*) FILTER (articles_no_keywords > 0) AS locations_no_keywords,
      count(*) FILTER (articles_keywords > 0) AS locations_keywords FROM totals""",
)
def level_location_summary(spark, directory):
    return R.level_summary(R.location_totals(daily_table(spark, directory), "xa", 1))


@query(
    "category_share_weekly",
    f"""WITH {_WEEKLY}
    SELECT location, date, CAST(yearweek(date) % 100 AS INTEGER) AS iso_week,
      CAST(cv AS DOUBLE) / nullif(cv + eci + fc, 0) AS share_cv,
      CAST(eci AS DOUBLE) / nullif(cv + eci + fc, 0) AS share_eci,
      CAST(fc AS DOUBLE) / nullif(cv + eci + fc, 0) AS share_fc
    FROM weekly""",
)
def category_share_weekly(spark, directory):
    shares = R.category_shares(_weekly(spark, directory), X.CATEGORIES)
    return shares.select(
        "location",
        "date",
        F.weekofyear("date").alias("iso_week"),
        *[f"share_{c}" for c in X.CATEGORIES],
    )


@query(
    "country_daily_series",
    f"""WITH {X.SQL_MENTIONS}
    SELECT date, location AS country, count(*) AS n_articles
    FROM loc WHERE location IN ('xa', 'xb') GROUP BY ALL""",
)
def country_daily_series(spark, directory):
    return R.country_series(daily_sets(spark, directory), X.COUNTRIES)


@query(
    "country_daily_keyword_series",
    f"""WITH {X.SQL_MENTIONS}
    SELECT date, location AS country, count(*) AS n_articles
    FROM loc WHERE location IN ('xa', 'xb') AND article_id IN (SELECT article_id FROM any_kw)
    GROUP BY ALL""",
)
def country_daily_keyword_series(spark, directory):
    return R.country_series(daily_sets(spark, directory), X.COUNTRIES, with_keyword=True)


@query(
    "iso_week_starts",
    f"""WITH {X.SQL_ARTICLES}
    SELECT CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(weekofyear(date) AS INTEGER) AS iso_week,
      min(date) AS first_date FROM articles GROUP BY ALL""",
)
def iso_week_starts(spark, directory):
    return R.iso_week_starts(articles(spark, directory))


def _country_share_sql(measures):
    cells = ", ".join(
        f"CAST(sum({m}) AS DOUBLE) / nullif(sum(count_articles), 0) AS {m}" for m in measures
    )
    return f"""shares AS (
      SELECT date, {cells} FROM daily WHERE split_part(location, '_', 1) = 'xa' GROUP BY date)"""


@query(
    "country_share_series",
    f"""WITH {X.SQL_DAILY}, {_country_share_sql([*X.CATEGORIES, "kw"])} SELECT * FROM shares""",
)
def country_share_series(spark, directory):
    return R.country_shares(daily_table(spark, directory), "xa", [*X.CATEGORIES, "kw"])


@query(
    "top_keywords",
    f"""WITH {X.SQL_DAILY}, {_country_share_sql(X.KEYWORD_IDS)}
    SELECT keyword, round(avg(share), 9) AS mean_share
    FROM (UNPIVOT shares ON {", ".join(X.KEYWORD_IDS)} INTO NAME keyword VALUE share)
    GROUP BY keyword ORDER BY mean_share DESC, keyword LIMIT 3""",
)
def top_keywords(spark, directory):
    shares = R.country_shares(daily_table(spark, directory), "xa", X.KEYWORD_IDS)
    return R.top_measures(shares, X.KEYWORD_IDS, 3)


@query(
    "length_quantiles",
    f"""WITH {X.SQL_ARTICLES}
    SELECT lang, count(*) AS n, CAST(sum(length(body)) AS DOUBLE) / count(*) AS mean,
      CAST(min(length(body)) AS INTEGER) AS min, CAST(max(length(body)) AS INTEGER) AS max,
      quantile_cont(CAST(length(body) AS DOUBLE), 0.5) AS q50,
      round(quantile_cont(CAST(length(body) AS DOUBLE), 0.98), 6) AS q98
    FROM articles GROUP BY lang""",
)
def length_quantiles(spark, directory):
    measured = M.article_lengths(articles(spark, directory))
    quantiles = S.length_quantiles(measured, "lang", "body_len", [0.5, 0.98])
    return quantiles.withColumn("q98", F.round("q98", 6))


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""edges AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
    SELECT CAST(least({bins - 1}, floor(({column} - lo) / ((hi - lo) / {float(bins)}))) AS INTEGER) AS bin,
      count(*) AS n
    FROM {source}, edges GROUP BY 1"""


@query(
    "score_histogram",
    f"WITH {SQL_PAYWALL}, {_histogram_sql('paywall', 'paywall_score', 1000)}",
)
def score_histogram(spark, directory):
    return S.histogram(paywall_table(spark, directory), "paywall_score", 1000)


_DELAY = """delays AS (
  SELECT date_diff('second', o_orderdate, l_shipdate) / 3600.0::DOUBLE AS delay_hours
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@query("publish_delay_histogram", f"WITH {_DELAY}, {_histogram_sql('delays', 'delay_hours', 50)}")
def publish_delay_histogram(spark, directory):
    items = table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"
    )
    orders = table(spark, directory, "orders").select("o_orderkey", "o_orderdate")
    delay = DT.hours_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("delay_hours")
    return S.histogram(items.join(orders, "o_orderkey").select(delay), "delay_hours", 50)


@query(
    "paywall_by_source",
    f"""WITH {SQL_PAYWALL}
    SELECT source, round(avg(paywall_score), 9) AS mean_score,
      count(*) FILTER (paywall_hits = 0) AS no_hit FROM paywall GROUP BY source""",
)
def paywall_by_source(spark, directory):
    return paywall_table(spark, directory).groupBy("source").agg(
        F.round(F.avg("paywall_score"), 9).alias("mean_score"),
        F.count_if(F.col("paywall_hits") == 0).alias("no_hit"),
    )


@query(
    "paywall_top200",
    f"""WITH {SQL_PAYWALL}
    SELECT article_id, paywall_score FROM paywall ORDER BY paywall_score DESC, article_id LIMIT 200""",
)
def paywall_top200(spark, directory):
    scored = paywall_table(spark, directory).select("article_id", "paywall_score")
    return scored.orderBy(F.desc("paywall_score"), "article_id").limit(200)


@query(
    "lowest_paywall_scores",
    f"WITH {SQL_PAYWALL} SELECT * FROM paywall ORDER BY paywall_score NULLS LAST, article_id LIMIT 20",
)
def lowest_paywall_scores(spark, directory):
    return S.lowest(paywall_table(spark, directory), "paywall_score", ["article_id"])
