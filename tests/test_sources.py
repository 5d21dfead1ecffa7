"""Files: CSV and JSON articles, names, exports, dictionaries, snapshots."""

import csv
import gzip
import json

import pytest
from pyspark.sql import functions as F

from presslens.operators import providers as P
from presslens.sources import articles as A
from presslens.sources import dictionaries as D
from presslens.sources import exports as E
from presslens.sources import results as R

HEADER = ["uri", "url", "title", "body", "lang", "source", "date", "userHasPermissions"]


def write_articles(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(HEADER)
        writer.writerows(rows)


def test_csv_bodies_span_lines_and_hold_quotes(spark, tmp_path):
    body = 'first "line",\nsecond, line'
    write_articles(
        tmp_path / "x_eng.csv",
        [["1", "u1", "t", body, "eng", "{'uri': 'a.com', 'title': \"A's\"}", "2024-06-24", "x"]],
    )
    read = A.read_articles_csv(spark, str(tmp_path))
    row = read.first()
    assert row["body"] == body
    assert str(row["date"]) == "2024-06-24"
    assert row["file"] == "x_eng.csv"
    assert "userHasPermissions" not in read.columns
    assert read.select(A.parse_source(F.col("source")).alias("s")).first()["s"]["uri"] == "a.com"


def test_json_archive_is_read_flattened_and_split_by_year(spark, tmp_path):
    lines = [
        {"uri": "1", "date": "2014-01-05", "source": {"uri": "a.com", "title": "A"}},
        {"uri": "2", "date": "2024-12-31", "source": {"uri": "b.com", "title": None}},
        {"uri": "3", "date": "2013-12-31", "source": None},
        {"uri": "4", "date": "bad", "source": None},
    ]
    with gzip.open(tmp_path / "a.json.gz", "wt", encoding="utf-8") as handle:
        handle.write("\n".join(json.dumps(line) for line in lines) + "\n{broken\n")
    raw = A.read_articles_json(spark, str(tmp_path / "a.json.gz"))
    assert raw.count() == 4
    flat = A.flatten(raw)
    assert "source.uri" in flat.columns
    out = str(tmp_path / "by_year")
    A.write_by_year(flat, out)
    back = spark.read.parquet(out)
    assert {(r["uri"], r["year"]) for r in back.select("uri", "year").collect()} == {("1", 2014), ("2", 2024)}


def test_language_comes_from_the_file_name(spark):
    names = spark.createDataFrame([("a_eng.csv",), ("b_ara.csv",), ("c.csv",), ("ara_eng.csv",)], "file string")
    got = {r["file"]: r["language"] for r in A.with_file_language(names).collect()}
    assert got == {"a_eng.csv": "English", "b_ara.csv": "Arabic", "ara_eng.csv": "English"}


def test_file_names_carry_details(spark):
    names = spark.createDataFrame([("saudi_arabia_06162024_06302024_eng_1889_x.csv",), ("other.csv",)], "file string")
    first, second = names.select(A.file_details(F.col("file")).alias("d"), A.file_region(F.col("file")).alias("r")).collect()
    assert (first["d"]["region"], str(first["d"]["from_date"]), first["d"]["results"]) == ("saudi_arabia", "2024-06-16", 1889)
    assert first["r"] == "saudi_arabia"
    assert second["d"]["results"] is None


EXPORT = """Most mentioned sources
Documents: 1234 results

Sources,,
Source,Source Website,Document Count
"Daily, The",https://www.daily.com/x,700
Agency,,534
Language,,English
Region,,Saudi Arabia
Date,,06/16/2024 to 06/30/2024
Text,,
Results Found,,"1,234"
A,,1
B,,2
C,,3
D,,4
E,,5
F,,6
G,,7
H,,8
I,,9
"""


def test_export_envelope(spark, tmp_path):
    (tmp_path / "one.csv").write_text(EXPORT)
    (tmp_path / "two.csv").write_text(EXPORT.replace("1,234", "1,235"))
    files = spark.read.text(str(tmp_path), wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("text")
    )
    parsed = E.parse_export(files)
    row = parsed.where("file = 'one.csv' AND position = 0").first()
    assert (row["source"], row["website"], row["document_count"]) == ("Daily, The", "https://www.daily.com/x", "700")
    assert (row["lang"], row["region"], row["from_date"], row["to_date"], row["results"]) == (
        "eng", "saudi_arabia", "06162024", "06302024", 1234,
    )
    assert parsed.count() == 4
    assert {r["file"] for r in E.count_mismatches(parsed).collect()} == {"two.csv"}
    name = parsed.where("file = 'one.csv'").select(
        E.export_file_name(*[F.col(c) for c in ("region", "query_text", "from_date", "to_date", "lang", "results")]).alias("n")
    )
    assert name.first()["n"] == "saudi_arabia_06162024_06302024_eng_1234"


def test_export_values_stand_under_their_column(spark):
    swapped = EXPORT.replace("Source,Source Website,Document Count", "Source,Document Count,Source Website")
    swapped = swapped.replace(",,English", ",English,x").replace(",,06/", ",06/").replace("Text,,", 'Text,"a, Text, b",')
    swapped = swapped.replace(",,Saudi", ",Saudi").replace(',,"1,234"', ',"1,234"')
    files = spark.createDataFrame([(swapped,)], "text string")
    row = E.parse_export(files, schema="source STRING, document_count STRING, website STRING").first()
    assert (row["lang"], row["region"], row["from_date"], row["query_text"], row["results"]) == (
        "eng", "saudi_arabia", "06162024", "a, Text, b", 1234,
    )


def test_headlines_get_their_own_meta_line(spark):
    text = '\n'.join(
        [' Bread prices rise ("https://x/1")', "Times, 5, 17 June 2024, 300 words",
         'Floods ("https://x/2")', "Agency, 18 June 2024"]
    )
    files = spark.createDataFrame([("f", text)], "file string, text string")
    rows = E.extract_headlines(files, "https://x", "June 2024").orderBy("position").collect()
    assert [(r["headline"], r["source"], r["date"]) for r in rows] == [
        ("Bread prices rise", "Times", " 17 June 2024"), ("Floods", None, None),
    ]


def test_dictionary_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("cv_war", "eng", "war"), ("cv_war", "ara", "حرب")], "entity_id string, lang string, variant string"
    )
    places = spark.createDataFrame([("xa_01", "eng", "old town")], "entity_id string, lang string, variant string")
    D.write_keyword_variants(rows, str(tmp_path / "k"))
    D.write_location_variants(places, str(tmp_path / "l"))
    read = D.read_dictionary(spark, str(tmp_path / "k"), str(tmp_path / "l"), "eng")
    assert {tuple(r) for r in read.collect()} == {("keyword", "cv_war", "war"), ("location", "xa_01", "old town")}


def test_snapshot_is_not_replaced(spark, tmp_path):
    frame = spark.range(3)
    path = R.publish_snapshot(frame, str(tmp_path), "2024-07-01")
    assert R.read_daily_files(spark, path).count() == 3
    with pytest.raises(Exception):
        R.publish_snapshot(frame, str(tmp_path), "2024-07-01")


def test_one_folder_per_level(spark, tmp_path):
    places = spark.createDataFrame([("xa", 0), ("xa_1", 1), ("xa_2", 1), ("xa_1_1", 2)], "id string, adml int")
    R.write_by_level(places, str(tmp_path / "places"))
    second = spark.read.parquet(str(tmp_path / "places")).where("adml = 1")
    assert sorted(r["id"] for r in second.collect()) == ["xa_1", "xa_2"]
    assert sorted(p.name for p in (tmp_path / "places").glob("adml=*")) == ["adml=0", "adml=1", "adml=2"]


def test_group_names_match_without_their_suffix(spark):
    a = spark.createDataFrame([("agency", None, 3)], "title string, uri string, frequency int")
    b = spark.createDataFrame([("agency - all sources", None, 5)], "source string, uri string, document_count int")
    left, right = P.match_sources(a, b)
    assert left.first()["matched"] == 1 and right.first()["matched"] == 1
    assert right.first()["source"] == "agency"
