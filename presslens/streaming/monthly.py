"""Newly arrived article files: count each once, keep the daily table, publish when something is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.operators import daily as D
from presslens.operators import mentions as M
from presslens.sources.articles import typed, with_file_language
from presslens.sources.csv_ranges import csv_table, stream_files
from presslens.streaming import published as P

KEYS = ["date", "location", "admin_level", "language"]


def stage_output(name: Column, stage: str) -> Column:
    """Name of the file that a stage makes out of an input file."""
    return F.replace(name, F.lit(".csv"), F.lit(f"_{stage}.csv"))


def new_files(listing: DataFrame, done: DataFrame, stage: str) -> DataFrame:
    """Input files (`file`) whose output of the stage is not among the finished files (`file`)."""
    expected = listing.withColumn("output", stage_output(F.col("file"), stage))
    finished = done.select(F.col("file").alias("output")).distinct()
    return with_file_language(expected.join(finished, "output", "left_anti"))


def merge_daily(parts: DataFrame, measures: list[str], keys: list[str] = KEYS) -> DataFrame:
    """One row per key: late articles of a date are added to the counts the date already has.

    Counts of articles add up as long as every article is in one file only.
    """
    return parts.groupBy(*keys).agg(*[F.sum(m).cast("long").alias(m) for m in measures])


def distinct_articles(articles: DataFrame, key: str = "url") -> DataFrame:
    """Articles once each when input files overlap; without this they count once per file."""
    return articles.dropDuplicates([key])


def file_articles(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Articles of a batch of files (path, length), with their file name, whatever headers the files have.

    Columns are matched by header; those that no file of the batch has are null.
    """
    read = typed(csv_table(files), schema)
    lacking = [f for f in schema.fields if f.name.lower() not in {c.lower() for c in read.columns}]
    whole = read.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}) if lacking else read
    return whole.select(*schema.names, "file")


def landed_articles(files: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    """Parse the files of a batch once and number their rows; a repeated batch overwrites what it wrote before."""
    numbered = file_articles(files, schema).withColumn("article_id", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(numbered.schema).parquet(path)


# Codes of the file languages and their printed names.
LANGUAGES = {"eng": "English", "ara": "Arabic"}


def sets_of_files(batch: DataFrame, variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles (article_id, date, lang, body) of files in a known language, and their sets of places and keywords.

    `variants` has a `lang` column, and an article meets only the spellings of its file's language. Every
    row with an `article_id` of its own is an article, whatever its address; rows that are not numbered are here.
    """
    if "article_id" not in batch.columns:
        batch = batch.withColumn("article_id", F.monotonically_increasing_id())
    known = with_file_language(batch)
    codes = F.when(F.col("language") == "English", "eng").otherwise("ara")
    articles = known.select("article_id", "date", codes.alias("lang"), "body")
    return articles, M.entity_sets(articles, variants, ("date", "lang"), by_lang=True)


def daily_of_file_batch(
    batch: DataFrame, variants: DataFrame, keyword_ids: list[str], location_ids: list[str]
) -> DataFrame:
    """Daily rows of the articles of one batch, all languages in one pass."""
    articles, sets = sets_of_files(batch, variants)
    return D.daily_summary(articles, sets, keyword_ids, location_ids, languages=LANGUAGES)


def _run_available(files: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def run_update(
    spark: SparkSession,
    inbox: str,
    daily_path: str,
    checkpoint: str,
    variants: DataFrame,
    keyword_ids: list[str],
    location_ids: list[str],
    schema: T.StructType,
    publish: Callable[[DataFrame], None] | None = None,
) -> int:
    """Process all files that are new since the last call, then publish if there were any.

    Every batch is written to a folder of its own number, which a repeated batch overwrites, so a
    restart after a lost executor or driver neither loses nor repeats rows. Returns the number of
    batches that were not empty.
    """
    written = []

    def handle(batch: DataFrame, number: int) -> None:
        articles = landed_articles(batch, schema, f"{daily_path.rstrip('/')}.landed/batch={number}")
        if articles.isEmpty():
            return
        rows = daily_of_file_batch(articles, variants, keyword_ids, location_ids)
        rows.write.mode("overwrite").parquet(f"{daily_path}/batch={number}")
        written.append(number)

    _run_available(stream_files(spark, inbox), handle, checkpoint)
    if written and publish is not None:
        publish(spark.read.parquet(daily_path).drop("batch"))
    return len(written)


def run_running_table(
    spark: SparkSession,
    inbox: str,
    folder: str,
    checkpoint: str,
    variants: DataFrame,
    keyword_ids: list[str],
    location_ids: list[str],
    schema: T.StructType,
) -> int:
    """Keep one table of articles per day, place, language, category and keyword up to date with the files that arrive.

    The state is a table of counted cells, keyed by batch, day, language, place and measure. A batch writes its own
    cells, adds up the cells of the days it touches, whichever batches they are from, and publishes just these days
    (`published.current` reads the table). So late articles of any age change their own days only, and a batch that is
    repeated after a lost executor or driver changes nothing. Returns the number of batches that published something.
    """
    done, folder = [], folder.rstrip("/")

    def handle(batch: DataFrame, number: int) -> None:
        if P.is_published(spark, f"{folder}/table", number):
            return
        articles = landed_articles(batch, schema, f"{folder}/landed/batch={number}")
        if articles.isEmpty():
            return
        articles, sets = sets_of_files(articles, variants)
        cells = D.summary_cells(articles, sets, ("date", "lang"))
        cells.write.mode("overwrite").partitionBy("date").parquet(f"{folder}/cells/batch={number}")
        every = spark.read.schema(T.StructType([*cells.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{folder}/cells")
        # Batches behind this one have been there only if it is repeated; they will be added when they come again.
        every = every.where(F.col("batch") <= number).drop("batch")
        # One row per day of the batch; the days are folders, so only theirs are read.
        days = spark.read.schema(cells.schema).parquet(f"{folder}/cells/batch={number}").select("date").distinct()
        touched = every.join(F.broadcast(days), "date", "left_semi")
        rows = D.summary_of_cells(touched, keyword_ids, location_ids, LANGUAGES)
        P.replace_days(rows, f"{folder}/table", number)
        done.append(number)

    _run_available(stream_files(spark, inbox), handle, checkpoint)
    return len(done)


def stream_daily_counts(articles: DataFrame, variants: DataFrame, delay: str = "31 days") -> DataFrame:
    """Articles per day and location as a running stream with late data up to `delay`.

    `articles` is a stream with `article_id`, `published` (timestamp) and `body`; an article that
    arrives twice within the delay counts once. For the append and update output modes.
    """
    timed = articles.withWatermark("published", delay)
    places = variants.where("kind = 'location'")
    hits = M.spelling_hits(timed, places, ["article_id", "published"])
    once = hits.withColumnRenamed("entity_id", "location").dropDuplicatesWithinWatermark(
        ["article_id", "location"]
    )
    counted = once.groupBy(F.window("published", "1 day"), "location").agg(
        F.count("*").alias(D.ARTICLES)
    )
    return counted.select(F.to_date("window.start").alias("date"), "location", D.ARTICLES)
