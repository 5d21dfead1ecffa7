"""New files are counted once, late files add up, publishing happens only when something is new."""

import csv
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.sources.csv_ranges import csv_files
from presslens.streaming import monthly as I
from presslens.streaming import published as P

SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("url", "body")] + [T.StructField("date", T.DateType())]
)


def drop_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(["url", "body", "date"])
        writer.writerows(rows)


def variants(spark):
    rows = [
        ("keyword", "cv_war", "war", "eng"),
        ("keyword", "cv_war", "حرب", "ara"),
        ("location", "xa", "aland", "eng"),
        ("location", "xa", "ألاند", "ara"),
    ]
    return spark.createDataFrame(rows, "kind string, entity_id string, variant string, lang string")


def test_update_processes_each_file_once(spark, tmp_path):
    inbox, daily, check = tmp_path / "in", str(tmp_path / "daily"), str(tmp_path / "check")
    published = []

    def run():
        return I.run_update(
            spark, str(inbox), daily, check, variants(spark), ["cv_war"], ["xa"], SCHEMA,
            publish=lambda frame: published.append(frame.count()),
        )

    drop_file(inbox, "a_eng.csv", [["u1", "war in Aland,\nagain", "2024-01-01"], ["u2", "Aland", "2024-01-01"]])
    drop_file(inbox, "b_ara.csv", [["u3", "حرب ألاند", "2024-01-01"]])
    drop_file(inbox, "c_xyz.csv", [["u4", "war in Aland", "2024-01-01"]])
    assert run() == 1
    assert run() == 0
    assert len(published) == 1
    drop_file(inbox, "d_eng.csv", [["u5", "late war, Aland", "2024-01-01"]])
    assert run() == 1
    appended = spark.read.parquet(daily).drop("batch")
    english = appended.where("language = 'English'")
    assert sorted(r["count_articles"] for r in english.collect()) == [1, 2]
    merged = I.merge_daily(appended, ["count_articles", "cv", "cv_war", "kw"])
    got = {r["language"]: (r["count_articles"], r["kw"]) for r in merged.collect()}
    assert got == {"English": (3, 2), "Arabic": (1, 1)}
    assert len(published) == 2


def test_running_table_is_the_daily_summary_of_all_files(spark, tmp_path):
    inbox, folder, check = tmp_path / "in", str(tmp_path / "running"), str(tmp_path / "check")
    places = [("location", "xa", "aland", "eng"), ("location", "xa_01", "north aland", "eng"), ("location", "xa", "ألاند", "ara")]
    words = [("keyword", "cv_war", "war", "eng"), ("keyword", "eci_rain", "rain", "eng"), ("keyword", "cv_war", "حرب", "ara")]
    spellings = spark.createDataFrame([*places, *words], "kind string, entity_id string, variant string, lang string")
    keywords, locations = ["cv_war", "eci_rain"], ["xa", "xa_01"]

    def run():
        return I.run_running_table(spark, str(inbox), folder, check, spellings, keywords, locations, SCHEMA)

    def table():
        return {tuple(r[c] for c in columns) for r in P.current(spark, f"{folder}/table").collect()}

    def from_all():
        rows = I.daily_of_file_batch(I.file_articles(csv_files(spark, str(inbox)), SCHEMA), spellings, keywords, locations)
        return {tuple(r[c] for c in columns) for r in rows.collect()}

    columns = ["date", "location", "language", "admin_level", "count_articles", "cv", "cv_war", "eci", "eci_rain", "kw"]
    assert run() == 0 if inbox.mkdir() is None else None
    drop_file(inbox, "a_eng.csv", [["u1", "war in North Aland,\nrain", "2024-01-01"], ["u2", "nothing", "2024-01-02"]])
    drop_file(inbox, "b_ara.csv", [["u3", "حرب ألاند", "2024-01-01"], ["u4", "ألاند", "2024-01-03"], ["u5", "x", None]])
    assert run() == 1 and run() == 0
    first, closed = table(), P.current(spark, f"{folder}/table")
    assert first == from_all() and len({r[0] for r in first}) == 3
    # Late articles of one day, one of them in a file of another header.
    drop_file(inbox, "c_eng.csv", [["u6", "rain over Aland", "2024-01-01"]])
    with open(inbox / "d_eng.csv", "w", encoding="utf-8") as handle:
        handle.write("date,body\n2024-01-01,aland war\n")
    assert run() == 1
    assert table() == from_all() != first
    assert {tuple(r[c] for c in columns) for r in closed.collect()} == first
    day = dt.date(2024, 1, 1)
    assert {r for r in table() if r[0] != day} == {r for r in first if r[0] != day}
    held = spark.read.parquet(f"{folder}/table/data").groupBy("version").agg(F.collect_set("date").alias("days")).collect()
    assert {r["version"]: len(r["days"]) for r in held} == {0: 3, 1: 1}


def test_a_repeated_or_broken_update_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "table")
    made = lambda rows: spark.createDataFrame(rows, "date date, n long")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = lambda: sorted((r["date"], r["n"]) for r in P.current(spark, folder).collect())
    P.replace_days(made([(one, 1), (two, 1)]), folder, 0)
    P.replace_days(made([(one, 9)]), folder, 0)
    assert rows() == [(one, 1), (two, 1)]
    # The data of an update that was lost before its manifest: no reader sees them, and it is done again.
    made([(one, 5), (two, 5)]).write.partitionBy("date").parquet(f"{folder}/data/version=1")
    assert rows() == [(one, 1), (two, 1)] and P.versions(spark, folder) == [0]
    P.replace_days(made([(two, 2), (None, 7)]), folder, 1)
    assert rows() == [(one, 1), (two, 2)]
    assert sorted(r["n"] for r in P.current(spark, folder, 0).collect()) == [1, 1]


def test_new_files_need_an_output_per_stage(spark):
    listing = spark.createDataFrame([("a_eng.csv",), ("b_eng.csv",), ("c.csv",)], "file string")
    done = spark.createDataFrame([("a_eng_counts_per_day.csv",)], "file string")
    assert [r["file"] for r in I.new_files(listing, done, "counts_per_day").collect()] == ["b_eng.csv"]
    assert I.new_files(listing, done, "counts_per_article").count() == 2


def test_overlapping_files_can_be_made_distinct(spark):
    rows = spark.createDataFrame([("u1", "x"), ("u1", "x"), ("u2", "x")], "url string, body string")
    assert I.distinct_articles(rows).count() == 2


def test_running_counts_with_late_and_repeated_articles(spark, tmp_path):
    folder = tmp_path / "articles"
    day = dt.datetime(2024, 1, 1, 12)
    schema = "article_id long, published timestamp, body string"

    def add(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(folder))

    add([(1, day, "Aland"), (2, day, "aland Aland")])
    source = spark.readStream.schema(schema).parquet(str(folder))
    counted = I.stream_daily_counts(source, variants(spark).where("lang = 'eng'"), "10 days")
    writer = counted.writeStream.format("memory").queryName("running").outputMode("append")
    stream = writer.option("checkpointLocation", str(tmp_path / "check")).start()
    try:
        stream.processAllAvailable()
        # A repeated article, a late one, and one far ahead that closes the first day.
        add([(2, day, "Aland"), (3, day + dt.timedelta(hours=1), "Aland")])
        stream.processAllAvailable()
        add([(9, day + dt.timedelta(days=40), "Aland")])
        stream.processAllAvailable()
        rows = {str(r["date"]): r["count_articles"] for r in spark.sql("SELECT * FROM running").collect()}
    finally:
        stream.stop()
    assert rows == {"2024-01-01": 3}


def test_batch_name_rule(spark):
    row = spark.range(0, 1, 1, 1).select(I.stage_output(F.lit("x_eng.csv"), "counts_per_article").alias("o"))
    assert row.first()["o"] == "x_eng_counts_per_article.csv"
