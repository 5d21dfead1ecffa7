"""Matching the headlines of two providers."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import similarity
from presslens.operators.sizing import cut_lineage

# Executors get the compared functions with the job, so they need no copy of this package.
cloudpickle.register_pickle_by_value(similarity)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Distinct headlines per side that are compared in one task.
CELL_ROWS = 512


def exact_matches(a: DataFrame, b: DataFrame, text_a: str, text_b: str) -> DataFrame:
    """Per side, the headlines and those that the other side has too, both lower-cased.

    Equal headlines are counted before the join, so a headline that is repeated very often is one row.
    """
    left = a.groupBy(F.lower(text_a).alias("_t")).agg(F.count("*").alias("_na"))
    right = b.groupBy(F.lower(text_b).alias("_t")).agg(F.count("*").alias("_nb"))
    joined = left.where("_t IS NOT NULL").join(right.where("_t IS NOT NULL"), "_t", "full")
    both = F.col("_na").isNotNull() & F.col("_nb").isNotNull()

    def total(column, mask=F.lit(True)):
        return F.coalesce(F.sum(F.when(mask, F.col(column))), F.lit(0))

    return joined.agg(
        total("_na").alias("headlines_a"),
        total("_na", both).alias("exact_a"),
        total("_nb").alias("headlines_b"),
        total("_nb", both).alias("exact_b"),
    )


def _cells(df: DataFrame, other: DataFrame, own: str, cross: str, cell: int) -> DataFrame:
    """Deal the rows of a block into cells and repeat each row for every cell of the other side."""
    sizes = df.groupBy("_block").agg(F.ceil(F.count("*") / F.lit(cell)).alias("_own"))
    facing = other.groupBy("_block").agg(F.ceil(F.count("*") / F.lit(cell)).alias("_facing"))
    dealt = df.join(sizes, "_block").join(facing, "_block")
    return dealt.withColumns(
        {
            own: F.pmod(F.xxhash64("_norm"), F.col("_own")),
            cross: F.explode(F.sequence(F.lit(0).cast("long"), F.col("_facing") - 1)),
        }
    ).drop("_own", "_facing")


def _best_of_cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if left.empty or right.empty:
        return pd.DataFrame({"_block": [], "_norm": [], "_match": [], "_score": []})
    labels = right["_text"].tolist()
    best = similarity.best_in(left["_norm"].tolist(), right["_norm"].tolist(), labels)
    return pd.DataFrame(
        {
            "_block": left["_block"],
            "_norm": left["_norm"],
            "_match": [labels[at] for at, _ in best],
            "_score": [score for _, score in best],
        }
    )


def best_matches(
    queries: DataFrame,
    choices: DataFrame,
    text: str,
    choice: str,
    block: str | None = None,
    cell: int = CELL_ROWS,
) -> DataFrame:
    """Add the most similar headline of the other side and its score from 0 to 100.

    The score is the rounded insert/delete ratio of the cleaned headlines. Every headline is compared
    with all of the other side, or with those of the same `block` (for example one language and week),
    so the result is exact. Equal headlines are compared once, headlines that occur on both sides are
    settled by a join, and what remains is spread over a grid of cells of bounded size: a block of any
    size becomes many tasks, and a task returns one row per headline, never the pairs.
    """
    key = F.col(block).cast("string") if block else F.lit("")
    asked = queries.withColumns({"_block": key, "_norm": similarity.normalized(F.col(text))})
    offered = choices.where(F.col(choice).isNotNull()).select(
        key.alias("_block"),
        similarity.normalized(F.col(choice)).alias("_norm"),
        F.col(choice).alias("_text"),
    )
    # Both lists of distinct headlines are read several times below, so they are computed once.
    offered = cut_lineage(offered.groupBy("_block", "_norm").agg(F.min("_text").alias("_text")))
    wanted = asked.where(F.col("_norm").isNotNull()).select("_block", "_norm").distinct()
    wanted = cut_lineage(wanted)
    equal = wanted.where("_norm <> ''").join(offered, ["_block", "_norm"]).select(
        "_block", "_norm", F.col("_text").alias("_match"), F.lit(1.0).alias("_score")
    )
    rest = wanted.join(offered.where("_norm <> ''"), ["_block", "_norm"], "left_anti")
    cells = ["_block", "_row", "_column"]
    # A fixed number of partitions: a cell is little data but much work, so tasks must not be merged.
    spark = queries.sparkSession
    cores = spark.sparkContext.defaultParallelism
    tasks = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)
    left = _cells(rest, offered, "_row", "_column", cell).repartition(tasks, *cells)
    right = _cells(offered, rest, "_column", "_row", cell).repartition(tasks, *cells)
    best = (
        left.groupBy(*cells)
        .cogroup(right.groupBy(*cells))
        .applyInPandas(_best_of_cell, "_block string, _norm string, _match string, _score double")
    )
    pick = F.min_by(F.struct("_match", "_score"), F.struct(-F.col("_score"), F.col("_match")))
    nearest = best.groupBy("_block", "_norm").agg(pick.alias("_best"))
    nearest = nearest.select("_block", "_norm", "_best._match", "_best._score")
    matched = equal.unionByName(nearest)
    return (
        asked.join(matched, ["_block", "_norm"], "left")
        .withColumns(
            {
                "matched_title": F.col("_match"),
                "matched_score": F.bround(F.col("_score") * 100).cast("int"),
            }
        )
        .drop("_block", "_norm", "_match", "_score")
    )


def _both_of_cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    names = ["_side", "_block", "_norm", "_match", "_score"]
    if left.empty or right.empty:
        return pd.DataFrame({name: [] for name in names})
    sides = [(x, x["_norm"].tolist(), x["_text"].tolist(), x["_settled"].to_numpy()) for x in (left, right)]
    (_, a, of_a, done_a), (_, b, of_b, done_b) = sides
    found = similarity.best_both_ways(a, b, of_a, of_b, done_a, done_b)
    rows = [
        (side, block, text, labels[at], score)
        for side, (frame, texts, _, done), labels, best in zip((0, 1), sides, (of_b, of_a), found)
        for block, text, settled, (at, score) in zip(frame["_block"], texts, done, best)
        if not settled
    ]
    return pd.DataFrame(rows, columns=names)


def best_matches_both_ways(
    a: DataFrame, b: DataFrame, text_a: str, text_b: str, block: str | None = None, cell: int = CELL_ROWS
) -> tuple[DataFrame, DataFrame]:
    """`best_matches` of `a` among `b` and of `b` among `a`, for which every pair is compared once, not twice."""
    key = F.col(block).cast("string") if block else F.lit("")
    sides = [(a, text_a), (b, text_b)]
    asked = [x.withColumns({"_block": key, "_norm": similarity.normalized(F.col(text))}) for x, text in sides]
    texts = [
        cut_lineage(x.where(F.col(text).isNotNull()).groupBy("_block", "_norm").agg(F.min(text).alias("_text")))
        for x, (_, text) in zip(asked, sides)
    ]
    facing = [x.select("_block", "_norm", F.col("_text").alias("_match")) for x in reversed(texts)]
    equal = [x.where("_norm <> ''").join(y, ["_block", "_norm"]) for x, y in zip(texts, facing)]
    equal = [x.select("_block", "_norm", "_match", F.lit(1.0).alias("_score")) for x in equal]
    flags = [x.select("_block", "_norm", F.lit(True).alias("_found")) for x in equal]
    dealt = [
        x.join(y, ["_block", "_norm"], "left").withColumn("_settled", F.coalesce("_found", F.lit(False))).drop("_found")
        for x, y in zip(texts, flags)
    ]
    cells = ["_block", "_row", "_column"]
    # As in `best_matches`: tasks must not be merged.
    spark = a.sparkSession
    tasks = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    left = _cells(dealt[0], dealt[1], "_row", "_column", cell).repartition(tasks, *cells)
    right = _cells(dealt[1], dealt[0], "_column", "_row", cell).repartition(tasks, *cells)
    best = (
        left.groupBy(*cells)
        .cogroup(right.groupBy(*cells))
        .applyInPandas(_both_of_cell, "_side int, _block string, _norm string, _match string, _score double")
    )
    pick = F.min_by(F.struct("_match", "_score"), F.struct(-F.col("_score"), F.col("_match")))
    # Read by both directions, so it is computed once.
    nearest = cut_lineage(best.groupBy("_side", "_block", "_norm").agg(pick.alias("_best")))
    results = []
    for side in (0, 1):
        own = nearest.where(F.col("_side") == side).select("_block", "_norm", "_best._match", "_best._score")
        matched = asked[side].join(equal[side].unionByName(own), ["_block", "_norm"], "left")
        score = F.bround(F.col("_score") * 100).cast("int")
        named = matched.withColumns({"matched_title": F.col("_match"), "matched_score": score})
        results.append(named.drop("_block", "_norm", "_match", "_score"))
    return results[0], results[1]


def score_bands(df: DataFrame, score: str, key: str, k: int = 5) -> DataFrame:
    """k rows per score band (0, 10], (10, 20], …, picked by the hash of their key.

    The rank limit is applied map-side before the bands are brought together.
    """
    banded = df.where(F.col(score) > 0).withColumn("band", F.ceil(F.col(score) / 10).cast("int"))
    pick = Window.partitionBy("band").orderBy(F.md5(F.col(key).cast("string")), key)
    return banded.withColumn("_rank", F.row_number().over(pick)).where(F.col("_rank") <= k).drop("_rank")
