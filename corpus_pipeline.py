"""From raw documents to a training mixture: quality rules, near duplicates, benchmark leaks, secrets, mixing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all that the stage before it kept.
`run` writes each stage's rows to the shared folder and reads them again as the next one's documents. All but
the last stage return the columns of `documents`; the last adds `copy`, the number of a row's copy in the
mixture. Null ids, null or empty texts, repeated rows, empty tables and further columns have the results that
the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.llm import decontamination, jaccard_join, mixing, quality_rules, secrets
from presslens.llm.common import table, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for them."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", leaks),
    ("secret scans", redaction),
    ("mixing sources to target weights", mixture),
]

# Hashed n-gram weights and spaced seeds have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
