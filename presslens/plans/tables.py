"""The test tables in the shape of the news tables, for Spark and for the SQL side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import first_line


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def articles(spark: SparkSession, directory: str) -> DataFrame:
    """`documents` as articles; the date is made from the id."""
    documents = table(spark, directory, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 31).cast("int"))
    return documents.select(
        F.col("doc_id").alias("article_id"),
        day.alias("date"),
        "lang",
        "source",
        first_line(F.col("text")).alias("title"),
        F.col("text").alias("body"),
    )


def flagged_articles(spark: SparkSession, directory: str) -> DataFrame:
    """Articles with `is_duplicate`, played by the toxic label."""
    labels = table(spark, directory, "labels").select(
        F.col("doc_id").alias("article_id"), (F.col("toxic") == 1).alias("is_duplicate")
    )
    return articles(spark, directory).join(labels, "article_id", "left")


def rows(spark: SparkSession, columns: str, values: list[tuple]) -> DataFrame:
    """A small parameter table as a local relation, whose size Catalyst knows."""
    return spark.sql(f"SELECT * FROM VALUES {sql_values(values, backslash=True)} AS t({columns})")


def sql_values(values: list[tuple], backslash: bool = False) -> str:
    def literal(value):
        if value is None:
            return "CAST(NULL AS STRING)" if backslash else "CAST(NULL AS VARCHAR)"
        if isinstance(value, str):
            if backslash:
                return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            return "'" + value.replace("'", "''") + "'"
        return str(value)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in values)


SQL_ARTICLES = """articles AS (
  SELECT doc_id AS article_id, DATE '2024-01-01' + CAST(doc_id % 31 AS INTEGER) AS date,
         lang, source, split_part(text, chr(10), 1) AS title, text AS body
  FROM documents)"""
