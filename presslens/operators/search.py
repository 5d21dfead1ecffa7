"""Article search and what is counted over its results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search_articles(
    articles: DataFrame,
    groups: list[list[Column]],
    date_from: str | None = None,
    date_to: str | None = None,
    lang: str | None = None,
    skip_duplicates: bool = False,
) -> DataFrame:
    """Articles that satisfy at least one condition of every group.

    Conditions are columns, for example `mentions_any(body, phrases)` or `array_contains(concepts, x)`.
    Date and language come first, so they reach the scan and the text is only tested where they hold.
    """
    found = articles
    if lang is not None:
        found = found.where(F.col("lang") == lang)
    if date_from is not None:
        found = found.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        found = found.where(F.col("date") <= F.lit(date_to).cast("date"))
    if skip_duplicates:
        found = found.where(~F.coalesce(F.col("is_duplicate"), F.lit(False)))
    for conditions in groups:
        found = found.where(reduce(lambda a, b: a | b, conditions))
    return found


def time_series(found: DataFrame) -> DataFrame:
    """Articles per day."""
    return found.groupBy("date").agg(F.count("*").alias("count"))


def result_check(found: DataFrame) -> DataFrame:
    """Total and distinct results of a search, whether they agree, whether there are none."""
    totals = found.agg(
        F.count("*").alias("total_results"), F.countDistinct("article_id").alias("used_results")
    )
    return totals.withColumns(
        {
            "complete": F.col("total_results") == F.col("used_results"),
            "empty": F.col("used_results") == 0,
        }
    )


def top_sources(found: DataFrame, k: int = 100) -> DataFrame:
    """The k sources with most articles, each with the total over all articles, those without a source included.

    The total is one more row of the same aggregation and always comes first, so that only k + 1 rows
    meet in one task.
    """
    counted = (
        found.rollup("source")
        .agg(F.count("*").alias("n_articles"), F.grouping("source").alias("_all"))
        .where("_all = 1 OR source IS NOT NULL")
    )
    first = counted.orderBy(F.desc("_all"), F.desc("n_articles"), "source").limit(k + 1)
    total = F.max("n_articles").over(Window.partitionBy(F.lit(0)))
    return first.withColumn("total_results", total).where("_all = 0").drop("_all")


def keyword_country_matrix(
    sets: DataFrame, countries: list[str], keyword_ids: list[str]
) -> DataFrame:
    """Articles that mention a keyword and a country: keywords down, countries across, zero-filled."""
    cells = [F.count_if(F.array_contains("locations", c)).alias(c) for c in countries]
    counted = (
        sets.select("locations", F.explode("keywords").alias("keyword"))
        .groupBy("keyword")
        .agg(*cells)
    )
    names = sets.sparkSession.range(0, 1, 1, 1).select(F.explode(F.lit(keyword_ids)).alias("keyword"))
    empty = names.select("keyword", *[F.lit(0).cast("long").alias(c) for c in countries])
    sums = [F.sum(c).alias(c) for c in countries]
    return counted.unionByName(empty).groupBy("keyword").agg(*sums)


def overlap_estimate(sets: DataFrame, countries: list[str]) -> DataFrame:
    """How often articles are counted twice when countries are counted one by one.

    `separate` adds up the articles naming each country itself, `combined` counts them once; the sum
    over all levels is corrected by the ratio of the two.
    """
    whole = F.size(F.array_intersect("locations", F.lit(countries)))
    any_level = F.size(
        F.array_distinct(
            F.filter(
                F.transform("locations", lambda i: F.split_part(i, F.lit("_"), F.lit(1))),
                lambda c: c.isin(countries),
            )
        )
    )
    totals = sets.select(whole.alias("_w"), any_level.alias("_a")).agg(
        F.sum("_w").alias("separate"),
        F.count_if(F.col("_w") > 0).alias("combined"),
        F.sum("_a").alias("all_levels"),
    )
    # Null where no article names a country.
    ratio = F.try_divide(F.col("separate").cast("double"), F.col("combined").cast("double"))
    return totals.withColumns(
        {"overlap_share": ratio - 1.0, "corrected_total": F.round(F.try_divide(F.col("all_levels"), ratio))}
    )


def date_slices(spark, start: str, end: str, step: str | None) -> DataFrame:
    """Windows [slice_start, slice_end) that cut a range in days, months or years.

    Every start is made from the first one, so a month step from the 31st keeps to month ends. Without
    a step there is one window.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    one = spark.range(0, 1, 1, 1)
    if step is None:
        return one.select(first.alias("slice_start"), last.alias("slice_end"))
    every = F.expr({"d": "interval 1 day", "m": "interval 1 month", "y": "interval 1 year"}[step])
    starts = F.filter(F.sequence(first, last, every), lambda d: d < last)
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(last))
    return one.select(F.inline(F.arrays_zip(starts.alias("slice_start"), ends.alias("slice_end"))))


def slice_counts(articles: DataFrame, slices: DataFrame, cap: int) -> DataFrame:
    """Articles per window, and whether the window reaches the cap of one request.

    Windows are opened up into their days and joined by day: a hash join, not a comparison of every
    article with every window. Articles are counted per day first.
    """
    days = slices.withColumn(
        "date", F.explode(F.sequence("slice_start", F.date_sub("slice_end", 1)))
    )
    per_day = articles.groupBy("date").agg(F.count("*").alias("_n"))
    joined = days.join(per_day, "date", "left")
    n = F.coalesce(F.sum("_n"), F.lit(0)).cast("long")
    counted = joined.groupBy("slice_start", "slice_end").agg(n.alias("n_articles"))
    return counted.withColumn("saturated", F.col("n_articles") >= cap)
