"""Headlines of two providers: first lines of the documents against the benchmark items."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions.text import first_line
from presslens.operators import matching as H
from presslens.plans.registry import query
from presslens.plans.tables import articles, table


def _titles(spark, directory):
    return articles(spark, directory).select("article_id", "title")


def _headlines(spark, directory):
    return table(spark, directory, "benchmark").select("item_id", first_line(F.col("text")).alias("headline"))


# A headline is the whole first line, on both sides: a full stop may belong to an abbreviation.
_SQL_SIDES = """a AS (SELECT lower(split_part(text, chr(10), 1)) AS t FROM documents),
b AS (SELECT lower(split_part(text, chr(10), 1)) AS t FROM benchmark)"""


@query(
    "headline_exact",
    f"""WITH {_SQL_SIDES}
    SELECT (SELECT count(*) FROM a) AS headlines_a, (SELECT count(*) FROM a WHERE t IN (SELECT t FROM b)) AS exact_a,
      (SELECT count(*) FROM b) AS headlines_b, (SELECT count(*) FROM b WHERE t IN (SELECT t FROM a)) AS exact_b""",
)
def headline_exact(spark, directory):
    return H.exact_matches(_titles(spark, directory), _headlines(spark, directory), "title", "headline")


def _fuzzy_sql(words: int = 4, bits: int = 120) -> str:
    """Compare all pairs: the longest common subsequence, with a bit per character of the headline.

    A bit is set while its character is not yet part of the subsequence. `list_reduce` goes over the characters
    of the title; headlines may have `words * bits` characters, which the SQL checks.
    """
    full = f"((1::HUGEINT << {bits}) - 1)"
    sums: list[str] = []
    for k in range(1, words + 1):
        carry = f" + ({sums[-1]} >> {bits})" if sums else ""
        sums.append(f"(v[{k}] + (v[{k}] & m[{k}]){carry})")
    moved = ", ".join(f"({total} & {full}) | (v[{k}] - (v[{k}] & m[{k}]))" for k, total in enumerate(sums, 1))
    masks = ", ".join(f"bit_or(CASE WHEN (p - 1) // {bits} = {k} THEN 1::HUGEINT << CAST((p - 1) % {bits} AS INTEGER) ELSE 0::HUGEINT END)" for k in range(words))
    none = ", ".join([full] * words)
    return f"""WITH a AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS t FROM documents),
    b AS (SELECT item_id AS id, split_part(text, chr(10), 1) AS t FROM benchmark),
    ac AS (SELECT *, trim(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')) AS s FROM a),
    bc AS (SELECT *, trim(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')) AS s FROM b),
    an AS MATERIALIZED (SELECT s, min(t) AS label FROM ac WHERE s IS NOT NULL GROUP BY s),
    bn AS MATERIALIZED (SELECT s, min(t) AS label FROM bc WHERE s IS NOT NULL GROUP BY s),
    fits AS (SELECT CASE WHEN max(length(s)) > {words * bits} THEN error('a headline is too long') END FROM bn),
    chars AS (SELECT s, unnest(string_split(s, '')) AS c, unnest(generate_series(1, length(s))) AS p FROM an WHERE s <> ''),
    letters AS (SELECT s, unnest(string_split(s, '')) AS c, unnest(generate_series(1, length(s))) AS p FROM bn WHERE s <> ''),
    masks AS MATERIALIZED (SELECT s, c, [{masks}] AS m FROM letters GROUP BY s, c),
    steps AS (SELECT x.s AS sa, y.s AS sb, list(y.m ORDER BY x.p) AS ms FROM chars x JOIN masks y ON x.c = y.c GROUP BY ALL),
    ends AS (SELECT sa, sb, list_reduce(list_prepend([{none}], ms), lambda v, m: [{moved}]) AS v FROM steps),
    shared AS (SELECT sa, sb, {words * bits} - list_sum(list_transform(v, lambda w: bit_count(w)::INTEGER)) AS n FROM ends),
    scored AS MATERIALIZED (
      SELECT an.s AS sa, bn.s AS sb, an.label AS la, bn.label AS lb,
        2.0::DOUBLE * coalesce(n, 0) / greatest(length(an.s) + length(bn.s), 1) AS score
      FROM an CROSS JOIN bn LEFT JOIN shared ON sa = an.s AND sb = bn.s WHERE (SELECT * FROM fits) IS NULL),
    forth AS (SELECT sa AS s, min({{'r': -score, 'l': lb}}) AS best FROM scored GROUP BY sa),
    back AS (SELECT sb AS s, min({{'r': -score, 'l': la}}) AS best FROM scored GROUP BY sb)
    SELECT 'title' AS side, id, best.l AS matched_title, CAST(round_even(-best.r * 100, 0) AS INTEGER) AS matched_score
    FROM ac LEFT JOIN forth USING (s)
    UNION ALL
    SELECT 'headline', id, best.l, CAST(round_even(-best.r * 100, 0) AS INTEGER) FROM bc LEFT JOIN back USING (s)"""


# Both directions: every title with its best headline, every headline with its best title.
@query("headline_fuzzy_top1", _fuzzy_sql())
def headline_fuzzy_top1(spark, directory):
    titles = _titles(spark, directory)
    headlines = _headlines(spark, directory)
    forth, back = H.best_matches_both_ways(titles, headlines, "title", "headline")
    return forth.select(
        F.lit("title").alias("side"), F.col("article_id").alias("id"), "matched_title", "matched_score"
    ).unionByName(
        back.select(
            F.lit("headline").alias("side"), F.col("item_id").alias("id"), "matched_title", "matched_score"
        )
    )


@query(
    "score_band_sample",
    """WITH banded AS (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_extendedprice AS item,
        CAST(l_quantity * 2 AS INTEGER) AS score FROM lineitem),
    ranked AS (
      SELECT DISTINCT item, score FROM banded),
    picked AS (
      SELECT *, CAST(ceil(score / 10.0) AS INTEGER) AS band,
        row_number() OVER (PARTITION BY CAST(ceil(score / 10.0) AS INTEGER) ORDER BY md5(item), item) AS r
      FROM ranked WHERE score > 0)
    SELECT item, score, band FROM picked WHERE r <= 5""",
)
def score_band_sample(spark, directory):
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    scored = table(spark, directory, "lineitem").select(
        F.concat_ws("-", *[F.col(p).cast("string") for p in parts]).alias("item"),
        (F.col("l_quantity") * 2).cast("int").alias("score"),
    )
    return H.score_bands(scored.distinct(), "score", "item")
