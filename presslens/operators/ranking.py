"""Ordered operators that stay parallel inside one large group.

A window numbers a whole group in one task. Here the rows are dealt by one range partitioning of their order and sorted
inside the ranges, as many as the number of rows asks for; a row's place is its place in its range plus the rows of the
ranges before it. The input is computed once, as it is written before its order is sampled. The whole order
is cut, so rows that tie on its first column are spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.operators.sizing import stored

# Rows that are worth a range of their own, and how many ranges there are at most; a range beyond that is larger.
ROWS = 10_000
RANGES = 20_000


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with `_range`, the number of their range of an ascending order, and `_place` in it, from 0.

    The result is written, so that whatever reads it meets the same ranges.
    """
    once = stored(df, "unordered")
    ranges = max(1, min(RANGES, -(-once.count() // ROWS)))
    dealt = once.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    numbered = dealt.withColumn("_id", F.monotonically_increasing_id())
    # The number of the partition is above the lower 33 bits.
    split = numbered.withColumns(
        {"_range": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    return stored(split.drop("_id"), "ranges")


def _rejoin(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null, keeping the keys of `df`."""
    renamed = side.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return df.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])


def number_rows(df: DataFrame, groups: list[str], order: list[Column], name: str = "number") -> DataFrame:
    """`row_number` per group along an ascending total order."""
    ranged = in_ranges(df, [*[F.col(g) for g in groups], *order])
    # At most RANGES rows are left here and broadcast.
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = ranged.join(F.broadcast(offsets), "_range").withColumn("_place", F.col("_offset") + F.col("_place"))
    placed = placed.drop("_offset", "_range")
    if not groups:
        return placed.withColumn(name, (F.col("_place") + 1).cast("long")).drop("_place")
    first = placed.groupBy(*groups).agg(F.min("_place").alias("_first"))
    numbered = _rejoin(placed, first, groups)
    return numbered.withColumn(name, (F.col("_place") - F.col("_first") + 1).cast("long")).drop("_place", "_first")


def forward_fill(df: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """Replace nulls by the last value before them in the ascending order of the whole table."""
    ranged = in_ranges(df, order)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_place"))).alias(f"_last_{c}") for c in columns]
    # One row per range, so the window over all of them is small however large the table is.
    ends = ranged.groupBy("_range").agg(*last)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_range",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns],
    )
    upto = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most RANGES rows are broadcast.
    joined = ranged.join(F.broadcast(carried), "_range", "left")
    filled = joined.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_carry_{c}")) for c in columns}
    )
    return filled.drop("_range", "_place", *[f"_carry_{c}" for c in columns])


def quantiles(df: DataFrame, by: str, value: str, weight: str, shares: dict[str, float]) -> DataFrame:
    """Exact linear quantiles per group of values that count `weight` times (a whole number above 0).

    `df` has one row per group and value. The ranks asked for are looked up in the summed weights of the ranges; only
    the ranges that hold one are gone through row by row, so no task holds the values of a whole group.
    """
    ranged = in_ranges(df.select(by, F.col(value).cast("double").alias("_v"), F.col(weight).cast("long").alias("_w")), [F.col(by), F.col("_v")])
    cells = ranged.groupBy(by, "_range").agg(F.sum("_w").alias("_n"))
    whole = Window.partitionBy(by)
    upto = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumns({"_end": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
    ranks = []
    for share in shares.values():
        at = F.lit(share) * (F.col("_total") - 1)
        ranks += [F.floor(at), F.ceil(at)]
    wanted = F.filter(F.array_distinct(F.array(*ranks)), lambda k: (k >= F.col("_end") - F.col("_n")) & (k < F.col("_end")))
    cells = cells.select(by, "_range", (F.col("_end") - F.col("_n")).alias("_before"), "_total", wanted.alias("_ranks"))
    inside = Window.partitionBy(by, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _rejoin(ranged, cells.where(F.size("_ranks") > 0), [by, "_range"]).where("_total IS NOT NULL")
    rows = rows.withColumn("_end", F.col("_before") + F.sum("_w").over(inside))
    held = F.filter("_ranks", lambda k: (k >= F.col("_end") - F.col("_w")) & (k < F.col("_end")))
    found = rows.select(by, "_total", "_v", F.explode(held).alias("_k"))
    # Two rows per share and group are left.
    found = found.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_at"), F.max("_total").alias("_total"))

    def linear(share: float) -> Column:
        at = F.lit(share) * (F.col("_total") - 1)
        low, high = (F.element_at("_at", f(at)) for f in (F.floor, F.ceil))
        between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        return F.when(F.floor(at) == F.ceil(at), low).otherwise(between)

    return found.select(by, *[linear(share).alias(name) for name, share in shares.items()])
