"""What the published counts mean, as properties of the daily table, and shapes of the plans."""

import pytest
from pyspark.sql import functions as F

from presslens.operators import daily as D
from presslens.operators import mentions as M
from presslens.operators import rollups as R
from presslens.operators import search as Q
from presslens.operators import series as S
from presslens.plans import QUERIES
from presslens.plans import fixtures as X
from presslens.plans.tables import articles

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def daily(spark):
    return QUERIES["daily_summary"](spark, DIRECTORY).cache()


def test_any_keyword_is_between_the_largest_and_the_sum_of_the_categories(daily):
    assert daily.where("kw > cv + eci + fc OR kw < greatest(cv, eci, fc)").count() == 0


def test_counts_are_nested(daily):
    assert daily.where("kw > count_articles OR cv > count_articles").count() == 0
    assert daily.where("cv_the > cv OR cv_of_the > cv OR fc_hyphen <> 0").count() == 0


def test_spine_is_dates_times_locations(spark, daily):
    dates = articles(spark, DIRECTORY).select("date").distinct().count()
    assert daily.count() == dates * len(X.LOCATION_IDS)


def test_full_calendar_adds_empty_days(spark):
    rows = spark.createDataFrame([(1, "2024-01-01", "la"), (2, "2024-01-04", "la")], "article_id long, date string, body string")
    rows = rows.withColumn("date", F.to_date("date"))
    sets = M.entity_sets(rows, X.dictionary(spark), ("date",))
    sparse = D.daily_summary(rows, sets, X.KEYWORD_IDS, ["xa"])
    full = D.daily_summary(rows, sets, X.KEYWORD_IDS, ["xa"], full_calendar=True)
    assert (sparse.count(), full.count()) == (2, 4)
    assert full.agg(F.sum("count_articles")).first()[0] == 2


def test_both_languages_in_one_pass_equal_the_union(spark):
    both = QUERIES["daily_summary_bilingual"](spark, DIRECTORY)
    parts = None
    for code, name in {"en": "English", "fr": "French"}.items():
        found = articles(spark, DIRECTORY).where(F.col("lang") == code)
        sets = M.entity_sets(found, X.dictionary(spark), ("date",))
        part = D.daily_summary(found, sets, X.KEYWORD_IDS, X.LOCATION_IDS, language=name)
        parts = part if parts is None else parts.unionByName(part)
    assert both.exceptAll(parts).count() == 0
    assert both.count() == parts.count()


def test_monthly_rollup_fills_months(spark):
    rows = [("xa", 0, "2024-01-31", 2, "English"), ("xa", 0, "2024-04-02", 1, "English")]
    frame = spark.createDataFrame(rows, "location string, admin_level int, date string, n long, language string")
    frame = frame.withColumn("date", F.to_date("date"))
    rolled = R.location_period_rollup(frame, "M", ["n"], ["language"]).orderBy("date").collect()
    assert [(str(r["date"]), r["n"]) for r in rolled] == [
        ("2024-01-31", 2), ("2024-02-29", 0), ("2024-03-31", 0), ("2024-04-30", 1),
    ]


def test_date_slices_keep_month_ends(spark):
    rows = Q.date_slices(spark, "2024-01-31", "2024-05-15", "m").orderBy("slice_start").collect()
    assert [str(r["slice_start"])[5:] for r in rows] == ["01-31", "02-29", "03-31", "04-30"]
    assert str(rows[-1]["slice_end"]) == "2024-05-15"
    assert Q.date_slices(spark, "2024-01-31", "2024-05-15", None).count() == 1


def test_grouped_total_keeps_days_of_one_side(spark):
    a = spark.createDataFrame([("2024-01-01", 2)], "date string, count long")
    b = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 4)], "date string, count long")
    total = {r["date"]: r["count"] for r in S.grouped_total([a, b]).collect()}
    assert total == {"2024-01-01": 3, "2024-01-02": 4}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"headline_fuzzy_top1"}))
def test_no_python_in_the_plans_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, DIRECTORY))
    assert "PythonUDF" not in text and "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text


def test_dictionary_is_broadcast_and_columns_are_pruned(spark):
    text = plan(QUERIES["daily_summary"](spark, DIRECTORY))
    assert "BroadcastHashJoin" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "source" not in text


def test_score_bands_limit_before_the_shuffle(spark):
    assert plan(QUERIES["score_band_sample"](spark, DIRECTORY)).count("WindowGroupLimit") == 2


def test_date_and_language_filters_reach_the_scan(spark):
    found = Q.search_articles(articles(spark, DIRECTORY), [], lang="en").select("article_id")
    assert "EqualTo(lang,en)" in plan(found)
