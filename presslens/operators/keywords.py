"""The keyword table and the keyword dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.names import capitalize_except_and
from presslens.operators import ranking

# Category names and their codes.
CATEGORY_CODES = {
    "Conflicts and Violence": "cv",
    "Political Instability": "pi",
    "Humanitarian Aid": "ha",
    "Economic Issues": "eci",
    "Agricultural Production Issues": "prs",
    "Weather Shocks": "ws",
    "Food Crisis": "fc",
    "Land-related Issues": "lri",
    "Pests and Diseases": "pad",
    "Forced Displacement": "fd",
    "Environmental Issues": "ei",
    "Other": "o",
    "New Category": "nc",
    "Any Keyword": "kw",
}

# Ids that repeat a keyword under the new category.
REPEATED_IDS = ["nc_food_sovereignty", "nc_failed_crops"]


def keyword_id(code: Column, keyword: Column) -> Column:
    """Category code and the words of the keyword, joined by underscores."""
    return F.concat(code, F.lit("_"), F.replace(keyword, F.lit(" "), F.lit("_")))


def keyword_table(
    translations: DataFrame,
    clusters: DataFrame,
    old_rows: int,
    codes: dict[str, str] = CATEGORY_CODES,
    repeated_ids: list[str] = REPEATED_IDS,
) -> DataFrame:
    """Keywords with translation, category and id, a copy of each under "Any Keyword", and one summary
    row per category.

    `translations` has (`position`, `english`, `arabic`), `clusters` (`keyword`, `cluster`). Missing
    values take the last value above them: among the first `old_rows` positions for all columns; after
    that a missing category is "New Category" and only the rest is filled.
    """
    joined = translations.join(clusters, F.col("english") == F.col("keyword"), "left").drop("keyword")
    position = F.col("position")
    raw = joined.withColumn("_raw_cluster", F.col("cluster"))
    filled = ranking.forward_fill(raw, ["english", "arabic", "cluster"], [position])
    # Looking back never leaves the old part, so one fill over the whole table serves both parts.
    cluster = F.when(position < old_rows, F.col("cluster")).otherwise(F.col("_raw_cluster"))
    merged = filled.select(
        "position",
        F.trim(F.lower("english")).alias("keyword_eng"),
        F.trim("arabic").alias("keyword_ara"),
        capitalize_except_and(F.coalesce(cluster, F.lit("New Category"))).alias("group_name"),
    )
    pairs = [F.lit(x) for item in codes.items() for x in item]
    code = F.element_at(F.create_map(*pairs), F.col("group_name"))
    with_id = merged.withColumn("column_name", keyword_id(code, F.col("keyword_eng")))
    kept = with_id.where(
        F.col("column_name").isNull() | ~F.col("column_name").isin(repeated_ids)
    ).drop("position")
    twice = kept.withColumn(
        "group_name", F.explode(F.array(F.col("group_name"), F.lit("Any Keyword")))
    )
    spark = translations.sparkSession
    names = F.map_entries(F.create_map(*pairs))
    summary = spark.range(0, 1, 1, 1).select(F.explode(names).alias("e")).select(
        F.lit(None).cast("string").alias("keyword_eng"),
        F.lit(None).cast("string").alias("keyword_ara"),
        F.col("e.key").alias("group_name"),
        F.col("e.value").alias("column_name"),
    )
    return twice.unionByName(summary)


def keyword_variants(table: DataFrame, lang: str) -> DataFrame:
    """(id, spelling) rows of one language from the keyword table."""
    column = {"eng": "keyword_eng", "ara": "keyword_ara"}[lang]
    rows = table.select(F.col("column_name").alias("entity_id"), F.col(column).alias("variant"))
    return rows.where("variant IS NOT NULL").distinct()


def keyword_dictionary(table: DataFrame, lang: str) -> DataFrame:
    """Sorted distinct spellings per keyword id."""
    variants = keyword_variants(table, lang)
    return variants.groupBy("entity_id").agg(F.array_sort(F.collect_set("variant")).alias("variants"))
