"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words: its weight's share of the total, but at most `MOST` times what
it has; what is cut off goes to the other sources by weight (water filling, in closed form). Every document
of a source is expected `target / source size` times. The expected copies are summed up along the source's
documents in the order of size and id, one offset is added, and a document comes out once per whole number
that its part of the sum crosses. In that order the words taken differ from the target by less than
about one document's size.

The order of a hot source is cut into ranges over (source, size, id), whose rows are numbered by
partition; only the ranges' row counts are summed per source. Cut points decide the balance, not the result.
All of it is column expressions.

Defined results: a null text has size 0 and is never taken more often than `MOST`; a null source is a source,
ordered last; a null id sorts first; repeated rows are documents of their own; a source without words has the
target 0 and no copies; an empty table gives an empty result. Equal rows may swap their copies.
The list of sources is a report-sized table: its waterline is computed over one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.common import unused, words_of, written

MOST = 3
SEED = "mix-1"
# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Targets of the sources in `sizes` (source, source_size): (source, source_size, target, rate)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    weighed = sizes.withColumn("_w", F.get(listed, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
    # Sources reach their cap in the order of cap per weight; the first that keeps below it sets the level.
    by_cap = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    above = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(above), F.lit(0))
    levels = weighed.withColumn("_level", left / F.sum("_w").over(onward))
    fits = F.when(F.col("_level") * F.col("_w") <= most * F.col("source_size"), F.col("_level"))
    level = F.first(fits, ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least((most * F.col("source_size")).cast("double"), F.col("_level") * F.col("_w"))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size")))
    return (
        levels.withColumn("_level", level)
        .withColumn("target", F.coalesce(target, F.lit(0.0)))
        .select("source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    )


def _offset(source: Column, seed: str) -> Column:
    """A fixed number in (0, 1) for a source, a whole number of 2^-21, so that sums with it stay exact."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 20))


def with_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str | None = "text",
    size_column: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Add `mix`, a struct (size, source_size, target, copies), to each row of `docs`, as the last column.

    The rows are written to the shared folder once, in order, with the columns they come with.
    """
    size_of = F.col(size_column) if size_column else F.size(words_of(F.col(text_column))).cast("long")
    mix, size, place = unused(docs, "mix"), unused(docs, "_size"), unused(docs, "_place")
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (source_column, size, id_column)]
    ranged = docs.withColumn(size, size_of).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number's upper bits are the partition, the lower ones the row's place in it.
    rows = written(ranged.withColumn(place, F.monotonically_increasing_id()), "mixing")
    part = F.shiftright(F.col(f"`{place}`"), 33)
    slim = rows.select(
        F.col(f"`{source_column}`").alias("source"),
        F.col(f"`{size}`").alias("size"),
        part.alias("part"),
        F.col(f"`{place}`").alias("place"),
    )
    ranges = slim.groupBy("source", "part").agg(
        F.min("place").alias("first"), F.count("*").alias("n"), F.sum("size").alias("words")
    )
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("source"), "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    known = targets.select(F.col("source").alias("_s"), "source_size", "target", "rate")
    # One row per source and range: small, and joined by shuffle if it should not be.
    side = offsets.join(known, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.struct("source", "part", "first", "earlier", "source_size", "target", "rate").alias(mix)
    )
    m = F.col(f"`{mix}`")
    joined = rows.join(side, F.col(f"`{source_column}`").eqNullSafe(m["source"]) & (part == m["part"]))
    number = (m["earlier"] + F.col(f"`{place}`") - m["first"]).cast("double")
    reached = lambda n: F.floor(_offset(m["source"], seed) + n * m["rate"])
    copies = F.least(F.lit(most), reached(number + 1) - reached(number)).cast("int")
    result = F.struct(
        F.col(f"`{size}`").alias("size"),
        m["source_size"].alias("source_size"),
        m["target"].alias("target"),
        copies.alias("copies"),
    )
    return joined.withColumn(mix, result).drop(size, place)


def mix_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, source, text) its size, its source's size and target, and the words taken.

    Only ids, sources and sizes are shuffled.
    """
    slim = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    mixed = with_copies(slim, size_column="size")
    m = F.col("mix")
    taken = (m["size"] * m["copies"]).cast("long").alias("taken")
    return mixed.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), taken)


def mix(docs: DataFrame) -> DataFrame:
    """The mixture itself: every row as often as it is taken, numbered from 1 in `copy` (the last column)."""
    mixed = with_copies(docs)
    name, copy = mixed.columns[-1], unused(docs, "copy")
    m = F.col(f"`{name}`")
    taken = mixed.where(m["copies"] > 0)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), m["copies"]))).drop(name)


# The same rows from DuckDB.
MIX_SQL = """WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::BIGINT AS w FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - 3 * coalesce(sum(source_size) OVER (
      ORDER BY source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(w) OVER (ORDER BY source_size / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM w),
f AS (SELECT *, (SELECT level FROM l WHERE level * w <= 3 * source_size ORDER BY source_size / w, encode(source) NULLS LAST LIMIT 1) AS line FROM l),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, line * w) AS target,
  (('0x' || substr(md5('mix-1:' || coalesce(source, '')), 1, 5))::BIGINT + 0.5::DOUBLE) / 1048576::DOUBLE AS u FROM f),
n AS (SELECT d.*, (row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST))::DOUBLE AS k FROM d),
r AS (SELECT n.*, t.source_size, t.target, t.u,
  CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target / t.source_size) ELSE 0 END AS rate
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * least(3, floor(u + k * rate) - floor(u + (k - 1) * rate)))::BIGINT AS taken FROM r"""
