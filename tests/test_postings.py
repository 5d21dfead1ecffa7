"""Searching the index gives the rows of the scan."""

from pyspark.sql import functions as F

from presslens.functions import text as T
from presslens.operators import postings as P


def test_phrases_fields_and_batches(spark, tmp_path):
    rows = [(1, "War news", "the north of the sea"), (2, None, "of the the of"), (3, "of", "the"), (4, "", None), (5, "Of The", "north north sea. Of-the x y")]
    articles = spark.createDataFrame(rows, "article_id long, title string, body string")
    folder = str(tmp_path / "index")
    for batch in (0, 1, 1):
        P.add_batch(articles.where(F.col("article_id") % 2 == batch), folder, batch)
    index = P.read_index(spark, folder)
    assert index.where("word = 'the'").count() == 7

    def both(groups):
        scanned = articles
        for group in groups:
            hit = F.lit(False)
            for field, phrase in group:
                hit = hit | F.coalesce(T.mentions_any(F.col(field), [phrase]), F.lit(False))
            scanned = scanned.where(hit)
        found = sorted(r["article_id"] for r in P.search_index(articles, index, groups).collect())
        assert found == sorted(r["article_id"] for r in scanned.collect())
        return found

    assert both([[("body", "of the")]]) == [1, 2, 5]
    assert both([[("body", "of the")], [("title", "of the"), ("title", "war")]]) == [1, 5]
    assert both([[("body", "north north sea of the"), ("title", "of")]]) == [3, 5]
    assert both([[("body", "the of the of")]]) == [] and both([[("body", "x y")]]) == []


def test_only_the_asked_words_are_read(spark, tmp_path):
    articles = spark.range(200).selectExpr("id AS article_id", "concat('word', id % 50, ' common') AS body")
    folder = str(tmp_path / "index")
    P.add_batch(articles, folder, 0, ("body",))
    found = P.matching_articles(P.read_index(spark, folder), [[("body", "word7 common")]])
    assert sorted(r[0] for r in found.collect()) == [7, 57, 107, 157]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "body" not in plan.replace("body)", "").split("ReadSchema")[1]
