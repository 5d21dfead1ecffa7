"""Two-level windows agree with plain windows, also for one group that holds nearly all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from presslens.operators import gazetteer as G
from presslens.operators import providers as P
from presslens.operators import ranking


@pytest.fixture(scope="module")
def hot(spark):
    group = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "b")
    return spark.range(5000).select(
        "id", group.alias("g"), (F.xxhash64("id") % 1000).alias("v"), F.concat(F.lit("é"), "id").alias("name")
    )


def test_running_number_is_row_number(hot):
    plain = F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("long")
    order = [F.col("v"), F.col("id")]
    both = ranking.number_rows(hot, ["g"], order, "n").withColumn("p", plain)
    assert both.count() == 5000
    assert both.where("n <> p").count() == 0


def test_running_number_by_text(hot):
    plain = F.row_number().over(Window.partitionBy("g").orderBy("name")).cast("long")
    both = ranking.number_rows(hot, ["g"], [F.col("name")], "n").withColumn("p", plain)
    assert both.where("n <> p").count() == 0


@pytest.fixture(autouse=True)
def small_ranges(monkeypatch):
    monkeypatch.setattr(ranking, "ROWS", 100)


@pytest.mark.parametrize("first", ["id", "name", "same"])
def test_ranges_are_even_also_for_ties_and_long_prefixes(hot, first):
    frame = hot.withColumn("name", F.concat(F.lit("https://en.example.org/wiki/"), "name"))
    frame = frame.withColumn("same", F.when(F.col("id") > 9, 1))
    sizes = ranking.in_ranges(frame, [F.col(first), F.col("id")]).groupBy("_range").count()
    assert sizes.agg(F.max("count")).first()[0] < 4 * ranking.ROWS
    assert sizes.count() > 5000 / ranking.ROWS / 2


def test_a_million_rows_are_more_than_64_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS", 10_000)
    sizes = ranking.in_ranges(spark.range(1_000_000), [F.xxhash64("id")]).groupBy("_range").count().collect()
    assert len(sizes) > 64 and max(r["count"] for r in sizes) < 30_000


def test_the_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(3000).mapInArrow(count, "id long")
    assert ranking.number_rows(frame, [], [F.col("id")], "n").where("n <> id + 1").count() == 0
    assert seen.value == 3000


def test_quantiles_are_those_of_all_values(spark):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 9 < 7 THEN 'hot' WHEN id % 9 = 7 THEN 'b' END AS g", "CAST(id * 7919 % 1237 AS DOUBLE) / 8 AS v", "id % 5 AS w")
    made = rows.where("w > 0").groupBy("g", "v").agg(F.sum("w").alias("w"))
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.987, "e": 1.0}
    plain = made.groupBy("g").agg(*[F.percentile("v", s, F.col("w")).alias(n) for n, s in shares.items()])
    got = {r["g"]: tuple(r)[1:] for r in ranking.quantiles(made, "g", "v", "w", shares).collect()}
    want = {r["g"]: tuple(r)[1:] for r in plain.collect()}
    assert set(got) == set(want) == {"hot", "b", None}
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_histogram_of_nulls_and_one_value(spark):
    from presslens.operators import stats

    frame = spark.createDataFrame([(1.0,), (None,), (2.0,), (3.0,)], "x double")
    assert {tuple(r) for r in stats.histogram(frame, "x", 2).collect()} == {(0, 1), (1, 2)}
    assert [tuple(r) for r in stats.histogram(frame.where("x = 2"), "x", 4).collect()] == [(0, 1)]
    assert stats.histogram(frame.where("x IS NULL"), "x", 4).collect() == []


def test_forward_fill(hot):
    gappy = hot.withColumn("v", F.when(F.col("id") % 700 == 5, F.col("v")))
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = gappy.withColumn("p", F.last("v", ignorenulls=True).over(window)).select("id", "p")
    filled = ranking.forward_fill(gappy, ["v"], [F.col("id")])
    joined = filled.join(plain, "id")
    assert joined.count() == 5000
    assert joined.where("NOT (v <=> p)").count() == 0
    assert joined.where("v IS NULL").count() == 5


def test_number_rows_of_an_empty_table(hot):
    empty = ranking.number_rows(hot.where("id < 0"), ["g"], [F.col("id")], "n")
    assert empty.count() == 0


def test_repeated_titles(spark):
    rows = [("a", "u1", 5), ("a", "u2", 9), ("a", "u0", 5), ("b", "u3", 1)]
    made = P.number_repeated_titles(spark.createDataFrame(rows, "title string, uri string, frequency long"))
    assert {(r["title"], r["uri"]) for r in made.collect()} == {
        ("a (1)", "u2"), ("a (2)", "u0"), ("a (3)", "u1"), ("b", "u3"),
    }


def test_pruning_long_names_agrees_with_comparing_all(spark):
    words = ["old", "new", "town", "by", "the", "sea", "of", "sand", "and", "wind", "hill"]
    names = [" ".join(words[i:j]) for i in range(0, 6) for j in range(i + 1, 12) if (i * j) % 4 != 1]
    frame = spark.createDataFrame([("p", n) for n in names], "k string, n string")
    kept = {r["n"] for r in G.prune_supersets(frame, "k", "n").collect()}
    sets = {n: set(n.split(" ")) for n in names}
    assert kept == {n for n in names if not any(sets[m] < sets[n] for m in names)}


def test_ids_spread_over_an_address_only_when_single(spark):
    rows = [("u", "a"), ("u", None), ("w", "a"), ("w", "b"), ("w", None), (None, None), ("x", None)]
    made = G.propagate_unique_id(spark.createDataFrame(rows, "uri string, id string"), "uri", "id")
    assert sorted(map(str, ((r["uri"], r["id"]) for r in made.collect()))) == sorted(
        map(str, [("u", "a"), ("u", "a"), ("w", "a"), ("w", "b"), ("w", None), (None, None), ("x", None)])
    )


def test_hot_address_keeps_all_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("uri"),
        F.when(F.col("id") == 7, "x1").alias("id"),
    )
    made = G.propagate_unique_id(rows, "uri", "id")
    assert made.count() == 3000
    assert made.where("id = 'x1'").count() == 2000
