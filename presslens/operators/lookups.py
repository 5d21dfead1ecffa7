"""Filters by list, masked updates, dictionary translation, outer joins with indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is in a short list."""
    return df.where(F.col(column).isin(values))


def keep_in_table(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose value occurs in a table of keys."""
    wanted = keys.select(F.col(key).alias(column))
    return df.join(wanted, column, "left_semi")


def drop_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is not in a short list; a missing value stays."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(values))


def masked_update(df: DataFrame, column: str, updates: list[tuple[Column, Column]]) -> DataFrame:
    """Set a column where a mask holds, one update after the other, each seeing the one before."""
    for mask, value in updates:
        df = df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))
    return df


def translate(df: DataFrame, column: str, mapping: DataFrame, target: str | None = None) -> DataFrame:
    """Replace values by a mapping (`key`, `value`); unknown values stay.

    A key that maps to null becomes null, so what counts is that the key is there.
    """
    names = mapping.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    joined = df.join(names, F.col(column) == F.col("_key"), "left")
    value = F.when(F.col("_key").isNotNull(), F.col("_value")).otherwise(F.col(column))
    return joined.withColumn(target or column, value).drop("_key", "_value")


def value_totals(df: DataFrame) -> DataFrame:
    """Number of values that are not null, for every column, in one pass."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every row."""
    present = value_totals(df).first()
    return df.drop(*[c for c in df.columns if present[c] == 0])


def right_with_unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Right join; `unmatched` marks the rows of the right side that found nothing."""
    marked = left.withColumn("_hit", F.lit(1))
    joined = marked.join(right, key, "right")
    return joined.withColumn("unmatched", F.col("_hit").isNull().cast("int")).drop("_hit")


def full_with_indicator(
    left: DataFrame, right: DataFrame, keys: list[str], name: str = "exist"
) -> DataFrame:
    """Full outer join; `exist` tells whether a row is in both, left_only or right_only."""
    a = left.withColumn("_in_left", F.lit(1))
    b = right.withColumn("_in_right", F.lit(1))
    joined = a.join(b, keys, "full")
    where = (
        F.when(F.col("_in_right").isNull(), "left_only")
        .when(F.col("_in_left").isNull(), "right_only")
        .otherwise("both")
    )
    return joined.withColumn(name, where).drop("_in_left", "_in_right")


def missing_ids(a: DataFrame, b: DataFrame, key: str, name_a: str, name_b: str) -> DataFrame:
    """Ids of either table that the other lacks; empty when both have the same ids."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return (
        left.join(right, key, "left_anti")
        .withColumn("missing_in", F.lit(name_b))
        .unionByName(right.join(left, key, "left_anti").withColumn("missing_in", F.lit(name_a)))
    )


def aligned_union(parts: list[DataFrame]) -> DataFrame:
    """Rows of all tables, columns matched by name, nulls where a table lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
