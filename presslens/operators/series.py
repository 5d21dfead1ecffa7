"""Daily count series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.dates import week_end


def between(df: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Rows of a closed date range."""
    return df.where(F.col("date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))


def before(df: DataFrame, cutoff: str) -> DataFrame:
    """Rows before a date."""
    return df.where(F.col("date") < F.lit(cutoff).cast("date"))


def monthly_totals(series: DataFrame) -> DataFrame:
    """Totals per month, labelled by its last day; months without a row appear with zero."""
    months = series.groupBy(F.last_day("date").alias("date")).agg(F.sum("count").alias("count"))
    # One row per month is left, few enough for one task.
    following = F.lead("date").over(Window.partitionBy(F.lit(0)).orderBy("date"))
    reach = months.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("date")))
    starts = F.sequence(F.trunc("date", "month"), F.col("_until"), F.expr("interval 1 month"))
    ends = F.filter(F.transform(starts, F.last_day), lambda d: d <= F.col("_until"))
    filled = reach.withColumn("_month", F.explode(ends))
    count = F.when(F.col("_month") == F.col("date"), F.col("count")).otherwise(F.lit(0))
    return filled.select(F.col("_month").alias("date"), count.cast("long").alias("count"))


def period_totals(series: DataFrame, key: str, date_from: str, date_to: str) -> DataFrame:
    """Total per key inside a closed period."""
    inside = between(series, date_from, date_to)
    return inside.groupBy(key).agg(F.sum("count").alias("count"))


def grouped_total(parts: list[DataFrame]) -> DataFrame:
    """Daily total over several series; a day missing from one of them keeps the others' count."""
    rows = reduce(DataFrame.unionByName, [p.select("date", "count") for p in parts])
    return rows.groupBy("date").agg(F.sum("count").alias("count"))


def side_by_side(series: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One column per series, null on days it does not have: a chain of outer joins in one shuffle."""
    cells = [F.sum(F.when(F.col(key) == n, F.col("count"))).alias(f"count_{n}") for n in names]
    return series.where(F.col(key).isin(names)).groupBy("date").agg(*cells)


def case_share(total: DataFrame, case: DataFrame) -> DataFrame:
    """Join a case series to its total by day; the share is in percent."""
    joined = total.withColumnRenamed("count", "count_total").join(
        case.select("date", F.col("count").alias("count_case")), "date"
    )
    share = F.col("count_case").cast("double") / F.col("count_total").cast("double") * 100
    return joined.withColumn("share", share)


def weekly_study(shares: DataFrame) -> DataFrame:
    """Complete weeks of a case study: summed counts, first country, mean share."""
    weekly = shares.groupBy(week_end(F.col("date")).alias("date")).agg(
        F.sum("count_total").alias("count_total"),
        F.min_by("country", "date").alias("country"),
        F.sum("count_case").alias("count_case"),
        F.round(F.avg("share"), 9).alias("share"),
        F.countDistinct("date").alias("_days"),
    )
    return weekly.where("_days = 7").drop("_days")
