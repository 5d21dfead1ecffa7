"""Files whose headers differ, values that cannot be read, and articles without an address."""

import csv
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.names import capitalize_except_and
from presslens.operators import daily, mentions, search
from presslens.schemas import ARTICLES_CSV
from presslens.sources import articles as A
from presslens.sources import results as R
from presslens.streaming import monthly as I


def put(path, header, *rows):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        csv.writer(handle).writerows([header, *rows])


def test_columns_are_matched_by_header(spark, tmp_path):
    put(tmp_path / "a_eng.csv", ["uri", "url", "body", "date"], ["1", "u1", "b1,\nb", "2024-01-01"])
    put(tmp_path / "b_eng.csv", ["url", "date", "body", "uri"], ["u2", "2024-01-02", "b2", "2"])
    put(tmp_path / "c d_eng.csv", ["body", "uri", "userHasPermissions"], ["b3", "3", "x"])
    rows = {r["uri"]: r for r in A.read_articles_csv(spark, str(tmp_path)).collect()}
    assert {k: (r["url"], r["body"]) for k, r in rows.items()} == {"1": ("u1", "b1,\nb"), "2": ("u2", "b2"), "3": (None, "b3")}
    assert rows["2"]["date"] == dt.date(2024, 1, 2) and rows["3"]["file"] == "c d_eng.csv" or rows["3"]["file"] == "c%20d_eng.csv"


def test_daily_files_are_matched_by_header(spark, tmp_path):
    put(tmp_path / "a.csv", ["date", "kw", "cv"], ["d1", "1", "2"])
    put(tmp_path / "b.csv", ["date", "cv", "kw"], ["d2", "4", "3"])
    put(tmp_path / "c.csv", ["date", "cv", "eci", "kw"], ["d3", "6", "7", "5"])
    rows = {r["date"]: (r["kw"], r["cv"], r["eci"]) for r in R.read_daily_files(spark, str(tmp_path)).collect()}
    assert rows == {"d1": ("1", "2", None), "d2": ("3", "4", None), "d3": ("5", "6", "7")}


def test_broken_values_are_null_and_counted(spark, tmp_path):
    put(tmp_path / "a_eng.csv", ["uri", "date"], ["1", "xx"], ["2", "2024-01-01"])
    assert [r["date"] for r in A.read_articles_csv(spark, str(tmp_path)).orderBy("uri").collect()] == [None, dt.date(2024, 1, 1)]
    raw = A.read_csv_by_header(spark, str(tmp_path))
    assert A.cast_rejects(raw, ARTICLES_CSV).first()["date"] == 1
    (tmp_path / "b.json").write_text('{"uri": "1"}\n{broken\n\n')
    assert A.read_articles_json(spark, str(tmp_path / "b.json")).count() == 1
    assert [r["line"] for r in A.json_rejects(spark, str(tmp_path / "b.json")).collect()] == ["{broken"]


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "body")] + [T.StructField("date", T.DateType())])


def update(spark, tmp_path):
    variants = spark.createDataFrame([("location", "xa", "aland", "eng")], "kind string, entity_id string, variant string, lang string")
    out = str(tmp_path / "daily")
    I.run_update(spark, str(tmp_path / "in"), out, str(tmp_path / "check"), variants, [], ["xa"], SCHEMA)
    return spark.read.parquet(out)


def test_every_row_is_an_article(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [["", "aland", "2024-01-01"]] * 2 + [["u", "aland", "2024-01-01"]] * 3
    put(tmp_path / "in" / "a_eng.csv", ["url", "body", "date"], *rows)
    assert [r["count_articles"] for r in update(spark, tmp_path).collect()] == [5]


def test_stream_files_with_other_headers_are_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "a[1]_eng.csv", ["date", "url", "body"], ["2024-01-01", "u", "aland"])
    put(tmp_path / "in" / "b_eng.csv", ["url", "body", "date"], ["u", "aland", "2024-01-01"])
    put(tmp_path / "in" / "c_eng.csv", ["body", "date", "more"], ["aland,\naland", "2024-01-01", "x"])
    assert [r["count_articles"] for r in update(spark, tmp_path).collect()] == [3]


def test_null_dates_are_in_no_row(spark):
    schema = "article_id long, date date, locations array<string>, keywords array<string>"
    sets = spark.createDataFrame([(1, None, ["xa"], ["cv_a"]), (2, dt.date(2024, 1, 1), ["xa"], ["cv_a"])], schema)
    for counted in (daily.location_counts(sets), daily.category_counts(sets), daily.keyword_counts(sets)):
        assert {r["date"] for r in counted.collect()} == {dt.date(2024, 1, 1)}


def test_totals_without_a_source_and_without_a_match(spark):
    found = spark.createDataFrame([("a",), (None,), (None,)], "source string")
    assert [tuple(r) for r in search.top_sources(found).collect()] == [("a", 1, 3)]
    sets = spark.createDataFrame([([],)], "locations array<string>")
    assert search.overlap_estimate(sets, ["xa"]).first()["overlap_share"] is None


def test_null_and_empty_spellings_are_found_nowhere(spark):
    kinds = "kind string, entity_id string, variant string"
    variants = spark.createDataFrame([("kw", "a", "war"), ("kw", "b", None), ("kw", "c", "")], kinds)
    articles = spark.createDataFrame([(1, "war and war"), (2, None)], "article_id long, body string")
    found = mentions.spelling_hits(articles, variants, ["article_id"]).collect()
    assert sorted((r["article_id"], r["entity_id"]) for r in found) == [(1, "a"), (1, "a")]
    assert mentions.spelling_hits(articles, variants.where("kind = 'x'"), ["article_id"]).count() == 0


def test_words_in_strings_stay(spark):
    printed = "{'uri': 'a.com', 'title': 'Sudan: None, so far', 'dataType': None}"
    row = spark.range(1).select(A.parse_source(F.lit(printed)).alias("s")).first()["s"]
    assert row["title"] == "Sudan: None, so far" and row["uri"] == "a.com"


def test_long_words_keep_their_end(spark):
    word = "A" * 1_000_010
    assert len(spark.range(1).select(capitalize_except_and(F.lit(word)).alias("w")).first()["w"]) == len(word)
