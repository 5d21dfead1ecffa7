"""A published table of days that readers can use while it is updated.

A version holds the days that an update replaced, in folders of its own. A manifest per version lists for every day
the version that holds it, and is written last, as one file: until it is there, readers see the table of the
version before, afterwards the new one, and a part of both never. Days that an update does not touch keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_MANIFEST = "date DATE, holder LONG, version LONG"


def _manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (date, holder, version) of all manifests; none before the first update."""
    try:
        # The folder is listed anew at every call.
        return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], _MANIFEST)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The published versions, oldest first."""
    found = _manifests(spark, folder).select("version").distinct().orderBy("version").collect()
    return [row["version"] for row in found]


def is_published(spark: SparkSession, folder: str, version: int) -> bool:
    """Whether an update of this version has been finished."""
    return not _manifests(spark, folder).where(F.col("version") == version).isEmpty()


def replace_days(rows: DataFrame, folder: str, version: int) -> None:
    """Replace the days that `rows` (date, ...) has by these rows, as a version above those that are there.

    A version that is finished is left alone, an unfinished one, which no reader has seen, is written again.
    """
    spark = rows.sparkSession
    if is_published(spark, folder, version):
        return
    path = f"{folder}/data/version={version}"
    rows.where("date IS NOT NULL").write.mode("overwrite").partitionBy("date").parquet(path)
    days = spark.read.schema(rows.schema).parquet(path).select("date").distinct()
    earlier = _manifests(spark, folder).where(F.col("version") < version)
    last = earlier.agg(F.max("version")).first()[0]
    kept = earlier.where(F.col("version") == last).select("date", "holder").join(F.broadcast(days), "date", "left_anti")
    manifest = kept.unionByName(days.withColumn("holder", F.lit(version).cast("long")))
    # A row per day: one file, which appears by one rename.
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/version={version}")


def current(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of a given one; later updates do not change what this frame reads."""
    manifests = _manifests(spark, folder)
    if version is None:
        version = manifests.agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"nothing is published in {folder}")
    # A row per day, collected so that the frame stays with this version; the days are folders, so no others are read.
    held = manifests.where(F.col("version") == version).groupBy("holder").agg(F.collect_list("date").alias("days")).collect()
    if not held:
        raise ValueError(f"version {version} is not published in {folder}")
    data = spark.read.parquet(f"{folder}/data")
    wanted = F.lit(False)
    for row in held:
        wanted = wanted | ((F.col("version") == row["holder"]) & F.col("date").isin(row["days"]))
    return data.where(wanted).drop("version")
