"""Dictionary files: spellings per keyword and location id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.daily import level_of
from presslens.schemas import KEYWORD_VARIANTS, LOCATION_VARIANTS


def read_dictionary(spark: SparkSession, keywords: str, locations: str, lang: str) -> DataFrame:
    """Spellings of one language as (kind, entity_id, variant), from two CSV folders."""

    def part(path, schema, kind):
        rows = spark.read.schema(schema).option("header", True).csv(path).where(F.col("lang") == lang)
        return rows.select(F.lit(kind).alias("kind"), "entity_id", "variant")

    return part(keywords, KEYWORD_VARIANTS, "keyword").unionByName(
        part(locations, LOCATION_VARIANTS, "location")
    )


def write_location_variants(dictionary: DataFrame, path: str) -> None:
    """Save (entity_id, lang, variant) rows with their level and country."""
    dictionary.select(
        "entity_id",
        level_of(F.col("entity_id")).alias("level"),
        F.split_part("entity_id", F.lit("_"), F.lit(1)).alias("country"),
        "lang",
        "variant",
    ).write.mode("errorifexists").option("header", True).csv(path)


def write_keyword_variants(dictionary: DataFrame, path: str) -> None:
    """Save (entity_id, lang, variant) rows with their category."""
    dictionary.select(
        "entity_id", F.split_part("entity_id", F.lit("_"), F.lit(1)).alias("category"), "lang", "variant"
    ).write.mode("errorifexists").option("header", True).csv(path)
