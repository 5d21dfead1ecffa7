"""Result files: reading what was written per input file, publishing snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.sources.articles import read_csv_by_header


def read_daily_files(spark: SparkSession, path: str) -> DataFrame:
    """All daily CSV files below a folder in one table, columns matched by header."""
    listing = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
    return read_csv_by_header(spark, path, listing=listing).drop("file")


def write_csv(df: DataFrame, path: str) -> None:
    """Save a result as CSV with a header; an existing result is not touched."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_by_level(places: DataFrame, path: str, level: str = "adml") -> None:
    """Save places in one folder per level, in one pass; a reader that asks for a level reads its folder only."""
    places.write.mode("errorifexists").partitionBy(level).parquet(path)


def publish_snapshot(df: DataFrame, folder: str, day: str | None = None) -> str:
    """Write the published table to a folder named after the day, and return its path.

    A second snapshot of the same day fails instead of replacing the first.
    """
    if day is None:
        day = df.sparkSession.range(0, 1, 1, 1).select(F.current_date().cast("string")).first()[0]
    path = f"{folder}/{day}_output"
    write_csv(df, path)
    return path
