"""Article search, daily series, case studies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from presslens.functions import text as T
from presslens.operators import postings as P
from presslens.operators import search as Q
from presslens.operators import series as S
from presslens.operators.sizing import shared_folder
from presslens.plans import fixtures as X
from presslens.plans.counting import daily_sets
from presslens.plans.registry import query
from presslens.plans.tables import articles, flagged_articles, table

_SQL_SEARCH = f"""{X.SQL_ARTICLES},
spaced AS (
  SELECT a.*, ' ' || array_to_string(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]{{2,}}'), ' ') || ' ' AS bw,
    ' ' || array_to_string(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]{{2,}}'), ' ') || ' ' AS tw
  FROM articles a LEFT JOIN labels ON doc_id = article_id
  WHERE coalesce(toxic, 0) <> 1),
found AS (
  SELECT article_id, date, lang, source FROM spaced
  WHERE (contains(bw, ' of the ') OR contains(bw, ' in to ') OR contains(tw, ' the '))
    AND (contains(bw, ' with ') OR contains(bw, ' by '))
    AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND lang = 'en')"""


def found_articles(spark, directory):
    body, title = F.col("body"), F.col("title")
    return Q.search_articles(
        flagged_articles(spark, directory),
        [
            [T.mentions_any(title, ["the"]), T.mentions_any(body, ["of the", "in to"])],
            [T.mentions_any(body, ["with", "by"])],
        ],
        "2024-01-05",
        "2024-01-25",
        "en",
        skip_duplicates=True,
    ).select("article_id", "date", "lang", "source")


@query("search_articles", f"WITH {_SQL_SEARCH} SELECT * FROM found")
def search_articles(spark, directory):
    return found_articles(spark, directory)


@query("search_articles_by_index", f"WITH {_SQL_SEARCH} SELECT * FROM found")
def search_articles_by_index(spark, directory):
    folder = f"{shared_folder(spark)}/presslens-postings-{uuid.uuid4().hex}"
    every = articles(spark, directory)
    # Two batches, as they would land one after the other.
    for batch in (0, 1):
        P.add_batch(every.where(F.pmod(F.col("article_id"), F.lit(2)) == batch), folder, batch)
    groups = [[("title", "the"), ("body", "of the"), ("body", "in to")], [("body", "with"), ("body", "by")]]
    known = Q.search_articles(flagged_articles(spark, directory), [], "2024-01-05", "2024-01-25", "en", skip_duplicates=True)
    return P.search_index(known.select("article_id", "date", "lang", "source"), P.read_index(spark, folder), groups)


@query("search_time_series", f"WITH {_SQL_SEARCH} SELECT date, count(*) AS count FROM found GROUP BY date")
def search_time_series(spark, directory):
    return Q.time_series(found_articles(spark, directory))


@query(
    "search_result_check",
    f"""WITH {_SQL_SEARCH}
    SELECT count(*) AS total_results, count(DISTINCT article_id) AS used_results,
      count(*) = count(DISTINCT article_id) AS complete, count(DISTINCT article_id) = 0 AS empty
    FROM found""",
)
def search_result_check(spark, directory):
    return Q.result_check(found_articles(spark, directory))


@query(
    "search_top_sources",
    f"""WITH {_SQL_SEARCH}
    SELECT source, count(*) AS n_articles, (SELECT count(*) FROM found) AS total_results
    FROM found GROUP BY source ORDER BY n_articles DESC, source LIMIT 100""",
)
def search_top_sources(spark, directory):
    return Q.top_sources(found_articles(spark, directory), 100)


@query(
    "keyword_country_matrix",
    f"""WITH {X.SQL_MENTIONS}
    SELECT k AS keyword, count(*) FILTER (location = 'xa') AS xa, count(*) FILTER (location = 'xb') AS xb
    FROM (SELECT DISTINCT entity_id AS k FROM dict WHERE kind = 'keyword')
    LEFT JOIN kw ON keyword = k LEFT JOIN loc USING (article_id) GROUP BY k""",
)
def keyword_country_matrix(spark, directory):
    return Q.keyword_country_matrix(daily_sets(spark, directory), X.COUNTRIES, X.KEYWORD_IDS)


@query(
    "overlap_estimate",
    f"""WITH {X.SQL_MENTIONS},
    t AS (
      SELECT CAST(count(*) FILTER (location IN ('xa', 'xb')) AS BIGINT) AS separate,
        count(DISTINCT article_id) FILTER (location IN ('xa', 'xb')) AS combined,
        count(DISTINCT (article_id, split_part(location, '_', 1))) AS all_levels FROM loc)
    SELECT *, separate / combined::DOUBLE - 1.0::DOUBLE AS overlap_share,
      round(all_levels / (separate / combined::DOUBLE)) AS corrected_total FROM t""",
)
def overlap_estimate(spark, directory):
    return Q.overlap_estimate(daily_sets(spark, directory), X.COUNTRIES)


def _slices_sql(start, months, end):
    return f"""starts AS (SELECT CAST(DATE '{start}' + to_months(CAST(i AS INTEGER)) AS DATE) AS slice_start
      FROM range({months}) t(i)),
    slices AS (SELECT slice_start, coalesce(lead(slice_start) OVER (ORDER BY slice_start),
      DATE '{end}') AS slice_end FROM starts)"""


@query(
    "date_slices_saturation",
    f"""WITH {_slices_sql('1995-01-31', 29, '1997-06-15')},
    dated AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders)
    SELECT slice_start, slice_end, count(date) AS n_articles, count(date) >= 100 AS saturated
    FROM slices LEFT JOIN dated ON date >= slice_start AND date < slice_end
    GROUP BY slice_start, slice_end""",
)
def date_slices_saturation(spark, directory):
    dated = table(spark, directory, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    slices = Q.date_slices(spark, "1995-01-31", "1997-06-15", "m")
    return Q.slice_counts(dated, slices, 100)


def event_series(spark, directory, key=None):
    """Events per day, optionally per a key column."""
    events = table(spark, directory, "events").withColumn("date", F.col("ts").cast("date"))
    by = ["date", key] if key else ["date"]
    return events.groupBy(*by).agg(F.count("*").alias("count"))


_SQL_EVENTS = """daily AS (SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS count
  FROM events GROUP BY ALL)"""


@query(
    "monthly_counts",
    """WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS count FROM orders GROUP BY 1),
    kept AS (SELECT last_day(date) AS date, sum(count) AS count FROM daily
             WHERE date < DATE '1998-07-15' GROUP BY 1),
    months AS (SELECT last_day(CAST(unnest(generate_series(
        CAST(date_trunc('month', min(date)) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)) AS date
      FROM kept)
    SELECT date, CAST(coalesce(count, 0) AS BIGINT) AS count FROM months LEFT JOIN kept USING (date)""",
)
def monthly_counts(spark, directory):
    orders = table(spark, directory, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    daily = orders.groupBy("date").agg(F.count("*").alias("count"))
    return S.monthly_totals(S.before(daily, "1998-07-15"))


@query(
    "keyword_period_totals",
    f"""WITH {_SQL_EVENTS}
    SELECT event_type, CAST(sum(count) AS BIGINT) AS count FROM daily
    WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type""",
)
def keyword_period_totals(spark, directory):
    series = event_series(spark, directory, "event_type")
    return S.period_totals(series, "event_type", "2024-01-05", "2024-01-20")


@query(
    "grouped_daily_total",
    f"""WITH {_SQL_EVENTS}
    SELECT date, CAST(sum(count) AS BIGINT) AS count FROM daily
    WHERE event_type IN ('click', 'view', 'error') GROUP BY date""",
)
def grouped_daily_total(spark, directory):
    series = event_series(spark, directory, "event_type")
    first = series.where(F.col("event_type").isin("click", "view"))
    second = series.where(F.col("event_type") == "error")
    return S.grouped_total([first, second])


_SERIES = ["click_1", "click_2", "view_1", "view_2", "error_1", "error_2", "purchase_1", "purchase_2"]
_SERIES_SQL = ", ".join(
    f"CAST(sum(CASE WHEN series = '{n}' THEN 1 END) AS BIGINT) AS count_{n}" for n in _SERIES
)


@query(
    "series_full_outer",
    f"""WITH marked AS (
      SELECT CAST(ts AS DATE) AS date,
        event_type || CASE WHEN hour(ts) < 12 THEN '_1' ELSE '_2' END AS series FROM events)
    SELECT date, {_SERIES_SQL} FROM marked
    WHERE series IN ({", ".join(f"'{n}'" for n in _SERIES)}) GROUP BY date""",
)
def series_full_outer(spark, directory):
    half = F.when(F.hour("ts") < 12, "_1").otherwise("_2")
    events = table(spark, directory, "events").select(
        F.col("ts").cast("date").alias("date"), F.concat("event_type", half).alias("series")
    )
    series = events.groupBy("date", "series").agg(F.count("*").alias("count"))
    return S.side_by_side(series, "series", _SERIES)


_SQL_STUDY = f"""{_SQL_EVENTS},
shares AS (
  SELECT t.date, t.count_total, c.count AS count_case,
    CAST(c.count AS DOUBLE) / CAST(t.count_total AS DOUBLE) * 100 AS share
  FROM (SELECT date, CAST(sum(count) AS BIGINT) AS count_total FROM daily GROUP BY date) t
  JOIN daily c ON c.date = t.date AND c.event_type = 'error'
  WHERE t.date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28')"""


def _study(spark, directory):
    total = S.between(event_series(spark, directory), "2024-01-03", "2024-01-28")
    per_type = event_series(spark, directory, "event_type")
    case = S.between(per_type.where(F.col("event_type") == "error"), "2024-01-03", "2024-01-28")
    return S.case_share(total, case)


@query("event_study_share", f"WITH {_SQL_STUDY} SELECT * FROM shares")
def event_study_share(spark, directory):
    return _study(spark, directory)


@query(
    "event_study_weekly",
    f"""WITH {_SQL_STUDY}
    SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS date,
      CAST(sum(count_total) AS BIGINT) AS count_total, 'xa' AS country,
      CAST(sum(count_case) AS BIGINT) AS count_case, round(avg(share), 9) AS share
    FROM shares GROUP BY 1 HAVING count(DISTINCT shares.date) = 7""",
)
def event_study_weekly(spark, directory):
    return S.weekly_study(_study(spark, directory).withColumn("country", F.lit("xa")))
