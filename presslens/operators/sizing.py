"""Choices that depend on how large an input is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Counted rows up to which a dictionary-like side is broadcast; beyond it Spark shuffles the join.
BROADCAST_ROWS = 200_000
# Text that `spread` may deal out.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one partition per core.

    Word counting is bound by CPU, so one small unsplittable file must not become one task. Inputs above
    `SPREAD_BYTES` are returned as they are: no more than that is ever dealt out.
    """
    if df.isStreaming:
        return df
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names in `spark.checkpoint.dir`.

    Where none is named, a local session gets a new folder of its own; on a cluster that would be another
    folder on every node, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    made = "file://" + tempfile.mkdtemp(prefix="presslens-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a frame that several branches read once, and keep it in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write a frame to the shared folder once and read it back, with its columns still to be chosen from."""
    path = f"{shared_folder(df.sparkSession)}/presslens-{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
