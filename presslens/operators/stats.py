"""Distributions: quantiles, histograms, value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.operators import ranking


def value_counts(df: DataFrame, columns: list[str], name: str = "n") -> DataFrame:
    """Rows per value; null values are left out."""
    return df.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias(name))


def lowest(df: DataFrame, column: str, ties: list[str], k: int = 20) -> DataFrame:
    """The k rows with the smallest values; rows without a value come last, equal ones by `ties`."""
    return df.orderBy(F.asc_nulls_last(column), *ties).limit(k)


def length_quantiles(df: DataFrame, by: str, column: str, shares: list[float]) -> DataFrame:
    """Mean, extremes and exact linear quantiles per group.

    Rows are first counted per distinct value; the quantiles are looked up by rank in ranges of the values.
    """
    per_value = df.dropna(subset=[column]).groupBy(by, column).agg(F.count("*").alias("_n"))
    n = F.col("_n")
    named = {"q" + f"{s:.2f}".split(".")[1]: s for s in shares}
    totals = per_value.groupBy(by).agg(
        F.sum(n).alias("n"),
        (F.sum(F.col(column).cast("long") * n).cast("double") / F.sum(n).cast("double")).alias("mean"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return _with_quantiles(totals, per_value, by, column, "_n", named)


def _with_quantiles(totals: DataFrame, per_value: DataFrame, by: str, value: str, weight: str, shares: dict[str, float]) -> DataFrame:
    found = ranking.quantiles(per_value, by, value, weight, shares).withColumnRenamed(by, "_by")
    return totals.join(found, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per bin of equal width between the smallest and the largest value.

    The last bin is closed on the right; bins without rows are absent. The extremes are found first, then each row
    names its bin, so that a task hands on at most a count per bin. The input is computed for both.
    """
    values = df.select(F.col(column).cast("double").alias("_x"))
    low, high = values.agg(F.min("_x"), F.max("_x")).first()
    width = ((high or 0.0) - (low or 0.0)) / bins
    place = F.floor((F.col("_x") - F.lit(low)) / F.lit(width)) if width > 0 else F.lit(0)
    bin_ = F.when(F.col("_x").isNotNull(), F.least(F.lit(bins - 1), place)).cast("int")
    # Nulls are left out by their count: a null test would be pushed down and compute every value twice.
    return values.groupBy(bin_.alias("bin")).agg(F.count("_x").alias("n")).where("n > 0")


def weighted_quartiles(df: DataFrame, value: str, weight: str, by: str) -> DataFrame:
    """Minimum, quartiles and maximum when every value is repeated `weight` times."""
    per_value = df.dropna(subset=[value, weight]).groupBy(by, value).agg(F.sum(weight).alias("_w"))
    kept = per_value.where("_w > 0")
    totals = kept.groupBy(by).agg(F.min(value).alias("min"), F.max(value).alias("max"))
    found = _with_quantiles(totals, kept, by, value, "_w", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return found.select(by, "min", "q1", "median", "q3", "max")
