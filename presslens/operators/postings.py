"""Article search over a stored index instead of the texts.

The index has a row per occurrence of a word: its article, field and place. It is kept in folders by bucket of the word, in
the order of words, so that a search reads the few files, and in them the row groups, of the words it asks for. A
batch of articles is added as a folder of its own; a repeated batch overwrites it. Phrases are verified by the
places of their words, so no text is read by a search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import text as T

BUCKETS = 64
SCHEMA = "article_id LONG, field STRING, place INT, word STRING, bucket INT, batch LONG"


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def add_batch(articles: DataFrame, folder: str, batch: int, fields: tuple[str, ...] = ("title", "body")) -> None:
    """Index the words of the fields of these articles (article_id, fields).

    The occurrences are dealt by ranges of bucket, word and article, so a very frequent word is many tasks.
    """
    parts = F.array(*[F.struct(F.lit(f).alias("field"), T.words(F.col(f)).alias("words")) for f in fields])
    whole = articles.select("article_id", F.explode(parts).alias("p")).select("article_id", "p.field", F.posexplode("p.words").alias("place", "word"))
    order = ["bucket", "word", "article_id"]
    dealt = whole.withColumn("bucket", _bucket(F.col("word"))).repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/batch={batch}")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def matching_articles(index: DataFrame, groups: list[list[tuple[str, str]]]) -> DataFrame:
    """Ids of articles that have, of every group, at least one (field, phrase); a phrase is words in a row.

    Every occurrence of a word of a phrase says where the phrase would begin; a phrase is there if all
    its words say the same.
    """
    asked = sorted({c for group in groups for c in group})
    words = [(k, field, place, word, len(phrase.split(" "))) for k, (field, phrase) in enumerate(asked) for place, word in enumerate(phrase.split(" "))]
    spark = index.sparkSession
    wanted = spark.createDataFrame(words, "k int, field string, shift int, word string, size int")
    named = sorted({w for _, _, _, w, _ in words})
    buckets = [r[0] for r in spark.range(0, 1, 1, 1).select(F.explode(F.lit(named)).alias("w")).select(_bucket(F.col("w"))).distinct().collect()]
    # The buckets choose folders, the words row groups.
    read = index.where(F.col("bucket").isin(buckets) & F.col("word").isin(named))
    hits = read.join(F.broadcast(wanted), ["field", "word"])
    begun = hits.groupBy("article_id", "k", "size", (F.col("place") - F.col("shift")).alias("begin")).agg(F.countDistinct("shift").alias("n"))
    # Per article at most the asked phrases.
    found = begun.where("n = size").groupBy("article_id").agg(F.collect_set("k").alias("found"))
    for group in groups:
        found = found.where(F.arrays_overlap("found", F.array(*[F.lit(asked.index(c)) for c in group])))
    return found.select("article_id")


def search_index(
    articles: DataFrame,
    index: DataFrame,
    groups: list[list[tuple[str, str]]],
) -> DataFrame:
    """The rows of `articles` that satisfy the groups; other conditions, as on dates, belong on `articles` before."""
    return articles.join(matching_articles(index, groups), "article_id", "left_semi")
