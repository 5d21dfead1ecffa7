"""Words, tables and folders that several operators of this package need."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.sizing import shared_folder

# The six characters that end a word, as a set for trimming and as a pattern for splitting.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; a null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_folder(spark)}/presslens-{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back, so that each reader gets the same rows.

    Parquet keeps column pruning, which a checkpoint loses. The files stay until the folder is cleared.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job below one folder, which go as soon as nothing is made of them any more."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.number = spark, new_folder(spark, purpose), 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        self.number += 1
        path = f"{self.folder}/{self.number}-{purpose}"
        df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(read)] = read, path
        return read

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no frame in use reads; what was made of them has been written."""
        for frame in frames:
            _, path = self.paths.pop(id(frame))
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def drop_all(self, *but: DataFrame) -> None:
        self.drop(*[frame for frame, _ in list(self.paths.values()) if all(frame is not b for b in but)])


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, most_bytes: int) -> DataFrame:
    """A `written` frame with a hint to broadcast it, if its files have at most `most_bytes` bytes.

    A larger one is returned without a hint, so that the join is planned as a shuffle.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most_bytes else df
