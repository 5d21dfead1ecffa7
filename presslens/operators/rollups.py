"""Roll-ups of the daily table and of the per-article id sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import dates as DT
from presslens.operators.daily import country_of, level_of


def distinct_texts(column: str) -> Column:
    """Aggregate: the distinct texts of a group, sorted, joined by a comma and a space."""
    return F.array_join(F.array_sort(F.collect_set(column)), ", ")


def location_period_rollup(
    daily: DataFrame, period: str, measures: list[str], texts: list[str]
) -> DataFrame:
    """Sum the measures and join the distinct texts per location and week, month or year.

    Periods are labelled by their last day. Periods without any row between the first and the last of
    a location appear with zeros. The level is a group key, not summed.
    """
    keys = ["location", "admin_level"]
    ending = daily.withColumn("date", DT.period_end(F.col("date"), period))
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in measures]
    rolled = ending.groupBy(*keys, "date").agg(*sums, *[distinct_texts(t).alias(t) for t in texts])
    # The gap up to the next period is filled from the rolled-up rows: one pass over the daily table.
    following = F.lead("date").over(Window.partitionBy(*keys).orderBy("date"))
    gaps = rolled.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("date")))
    if period == "M":
        months = F.sequence(F.trunc("date", "month"), F.col("_until"), DT.period_step(period))
        every = F.transform(months, F.last_day)
        every = F.filter(every, lambda d: d <= F.col("_until"))
    else:
        every = F.sequence(F.col("date"), F.col("_until"), DT.period_step(period))
    filled = gaps.withColumn("_day", F.explode(every))
    same = F.col("_day") == F.col("date")
    return filled.select(
        *keys,
        F.col("_day").alias("date"),
        *[F.when(same, F.col(m)).otherwise(F.lit(0)).cast("long").alias(m) for m in measures],
        *[F.when(same, F.col(t)).otherwise(F.lit("")).alias(t) for t in texts],
    )


def mention_funnel(sets: DataFrame) -> DataFrame:
    """Per country, articles that mention it, its provinces, its districts, with and without keywords.

    The levels at which an article names a country are found inside its row, so the article gives one
    row per country and nothing but the result is shuffled.
    """
    countries = F.array_distinct(F.transform("locations", country_of))
    named = sets.select(
        "locations", (F.size("keywords") > 0).alias("has_kw"), F.explode(countries).alias("country")
    )

    def at(level):
        return F.exists(
            "locations", lambda i: (country_of(i) == F.col("country")) & (level_of(i) == level)
        )

    flags = named.select("country", "has_kw", *[at(i).alias(f"l{i}") for i in range(3)])
    conditions = {
        "articles_country": F.col("l0"),
        "articles_country_provinces": F.col("l0") & F.col("l1"),
        "articles_provinces": F.col("l1"),
        "articles_country_districts": F.col("l0") & F.col("l2"),
        "articles_districts": F.col("l2"),
    }
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    counts += [F.count_if(c & F.col("has_kw")).alias(f"{n}_keywords") for n, c in conditions.items()]
    return flags.groupBy("country").agg(*counts)


def keyword_coverage(articles: DataFrame, sets: DataFrame) -> DataFrame:
    """All articles, and those with any keyword."""
    parts = articles.select(F.lit(1).alias("a"), F.lit(0).alias("k")).unionByName(
        sets.where(F.size("keywords") > 0).select(F.lit(0).alias("a"), F.lit(1).alias("k"))
    )
    return parts.agg(F.sum("a").alias("articles"), F.sum("k").alias("articles_keywords"))


def location_totals(daily: DataFrame, country: str, level: int) -> DataFrame:
    """Articles with and without keywords per location of one country and level."""
    picked = daily.where((country_of(F.col("location")) == country) & (F.col("admin_level") == level))
    return picked.groupBy("location").agg(
        F.sum("count_articles").alias("articles"),
        F.sum("kw").alias("articles_keywords"),
        (F.sum("count_articles") - F.sum("kw")).alias("articles_no_keywords"),
    )


def level_summary(totals: DataFrame) -> DataFrame:
    """How many locations there are, have articles without keywords, have articles with keywords."""
    return totals.agg(
        F.count("*").alias("locations"),
        F.count_if(F.col("articles_no_keywords") > 0).alias("locations_no_keywords"),
        F.count_if(F.col("articles_keywords") > 0).alias("locations_keywords"),
    )


def category_shares(rolled: DataFrame, categories: list[str]) -> DataFrame:
    """Share of each category in the sum of all categories of a row; null where there is none."""
    total = sum((F.col(c) for c in categories[1:]), F.col(categories[0])).cast("double")
    shares = {
        f"share_{c}": F.try_divide(F.col(c).cast("double"), total) for c in categories
    }
    return rolled.withColumns(shares)


def country_series(sets: DataFrame, countries: list[str], with_keyword: bool = False) -> DataFrame:
    """Articles per day that mention a country itself, optionally with any keyword too."""
    if with_keyword:
        sets = sets.where(F.size("keywords") > 0)
    places = sets.select("date", F.explode("locations").alias("country"))
    picked = places.where(F.col("country").isin(countries))
    return picked.groupBy("date", "country").agg(F.count("*").alias("n_articles"))


def iso_week_starts(articles: DataFrame) -> DataFrame:
    """First date with an article in every ISO week."""
    day = F.col("date")
    return articles.groupBy(
        DT.iso_year(day).alias("iso_year"), F.weekofyear(day).alias("iso_week")
    ).agg(F.min(day).alias("first_date"))


def country_shares(daily: DataFrame, country: str, measures: list[str]) -> DataFrame:
    """Per day, each measure summed over all locations of a country, over their summed articles."""
    picked = daily.where(country_of(F.col("location")) == country)
    total = F.sum("count_articles").cast("double")
    shares = [F.try_divide(F.sum(m).cast("double"), total).alias(m) for m in measures]
    return picked.groupBy("date").agg(*shares)


def top_measures(shares: DataFrame, measures: list[str], k: int) -> DataFrame:
    """The k measures with the largest mean share, ties by name."""
    long = shares.unpivot(["date"], measures, "keyword", "share")
    means = long.groupBy("keyword").agg(F.round(F.avg("share"), 9).alias("mean_share"))
    return means.orderBy(F.desc("mean_share"), "keyword").limit(k)


def display_names(variants: DataFrame, overrides: DataFrame) -> DataFrame:
    """First spelling of every id with its words capitalised, unless overridden."""
    first = variants.groupBy("entity_id").agg(F.min_by("variant", "position").alias("_first"))
    named = first.join(overrides, "entity_id", "left")
    return named.select(
        "entity_id", F.coalesce("display_name", F.initcap("_first")).alias("display_name")
    )


def share_over(df: DataFrame, value: str, by: list[str]) -> Column:
    """Value over its sum in a small, already aggregated table."""
    return F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy(*by)).cast("double"))
