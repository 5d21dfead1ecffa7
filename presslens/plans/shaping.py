"""Filters, masked updates, translations, unions, files and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import daily as D
from presslens.operators import lookups as L
from presslens.plans import fixtures as X
from presslens.plans.counting import daily_sets
from presslens.plans.registry import query
from presslens.plans.tables import rows, sql_values, table
from presslens.sources import articles as A
from presslens.sources import exports as E
from presslens.streaming import monthly


@query(
    "filter_isin",
    """SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
       WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
         AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))""",
)
def filter_isin(spark, directory):
    customers = table(spark, directory, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = L.keep_in(table(spark, directory, "nation"), "n_regionkey", [1, 2])
    picked = L.keep_in(customers, "c_mktsegment", ["HOUSEHOLD", "MACHINERY"])
    return L.keep_in_table(picked, "c_nationkey", nations, "n_nationkey")


@query(
    "filter_not_in",
    """SELECT p_partkey, p_name, nullif(p_type, 'SMALL') AS kind FROM part
       WHERE p_name <> 'small ring' AND (p_type IN ('SMALL') OR p_type <> 'ECONOMY')""",
)
def filter_not_in(spark, directory):
    parts = table(spark, directory, "part").select(
        "p_partkey", "p_name", F.nullif("p_type", F.lit("SMALL")).alias("kind")
    )
    return L.drop_in(L.drop_in(parts, "kind", ["ECONOMY"]), "p_name", ["small ring"])


@query(
    "masked_update",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'debt'
         WHEN c_mktsegment = 'HOUSEHOLD' AND c_nationkey < 10 THEN 'home' ELSE c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def masked_update(spark, directory):
    customers = table(spark, directory, "customer")
    home = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_nationkey") < 10)
    updates = [(home, F.lit("home")), (F.col("c_acctbal") < 0, F.lit("debt"))]
    return L.masked_update(customers, "c_mktsegment", updates).select(
        "c_custkey", "c_acctbal", "c_mktsegment"
    )


# Translations; one value is translated to nothing.
_TRANSLATIONS = [("HOUSEHOLD", "منزل"), ("MACHINERY", "آلات"), ("BUILDING", None)]


@query(
    "dictionary_translate",
    f"""SELECT c_custkey, CASE WHEN key IS NOT NULL THEN value ELSE c_mktsegment END AS c_mktsegment
       FROM customer LEFT JOIN (VALUES {sql_values(_TRANSLATIONS)}) m(key, value) ON key = c_mktsegment""",
)
def dictionary_translate(spark, directory):
    customers = table(spark, directory, "customer").select("c_custkey", "c_mktsegment")
    return L.translate(customers, "c_mktsegment", rows(spark, "key, value", _TRANSLATIONS))


@query("null_columns", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def null_columns(spark, directory):
    suppliers = table(spark, directory, "supplier")
    padded = suppliers.withColumns(
        {"min_x": F.lit(None).cast("double"), "status": F.when(F.col("s_suppkey") < 0, "gone")}
    )
    return L.drop_null_columns(padded)


@query(
    "union_daily_outputs",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
)
def union_daily_outputs(spark, directory):
    orders = table(spark, directory, "orders")

    def part(status, *columns):
        return orders.where(F.col("o_orderstatus") == status).select("o_orderkey", *columns)

    return L.aligned_union(
        [part("F", "o_totalprice"), part("O", "o_orderpriority"), part("P", "o_orderpriority", "o_totalprice")]
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, directory):
    return table(spark, directory, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "jsonl_flatten_by_year",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS event_kind, value AS event_value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, CAST(year(ts) AS INTEGER) AS year
       FROM events WHERE year(ts) BETWEEN 2014 AND 2024""",
)
def jsonl_flatten_by_year(spark, directory):
    nested = table(spark, directory, "events").select(
        "event_id",
        F.col("ts").cast("date").cast("string").alias("date"),
        F.struct(F.col("event_type").alias("kind"), "value").alias("event"),
        F.from_json("props", "k BIGINT").alias("props"),
    )
    return A.with_year(A.flatten(nested, "_"), 2014, 2024)


# One small export per supplier, as a downloaded file holds it: title, count, a line without use, column
# names, two data lines, fourteen footer lines.
_FOOTER_FILL = [f"Field {i},,value {i}" for i in range(9)]


@query(
    "export_envelope",
    """WITH two AS (SELECT s_suppkey, s_name, s_nationkey, unnest([0, 1]) AS position FROM supplier)
    SELECT s_suppkey, CAST(position AS INTEGER) AS position, lower(s_name) || CASE position WHEN 0 THEN ', daily' ELSE '' END AS source,
      CASE position WHEN 0 THEN 'https://www.' || s_nationkey || '.example/x' END AS website,
      CAST(s_suppkey + position AS VARCHAR) AS document_count, 'eng' AS lang, 'middle_east_' || s_nationkey AS region,
      '06162024' AS from_date, '06302024' AS to_date,
      CASE WHEN s_suppkey % 4 = 0 THEN 'bread, Text, wheat ' || s_suppkey END AS query_text,
      CAST(1000 + s_suppkey AS BIGINT) AS results, s_suppkey % 10 <> 3 AS counts_agree
    FROM two""",
)
def export_envelope(spark, directory):
    key = F.col("s_suppkey")
    header = 1000 + key + F.when(key % 10 == 3, 1).otherwise(0)
    name = F.lower("s_name")
    lines = [
        F.lit("Most mentioned sources"),
        F.concat(F.lit("Documents: "), header, F.lit(" results")),
        F.lit("Sources,,"),
        F.lit("Source,Source Website,Document Count"),
        F.concat(F.lit('"'), name, F.lit(', daily",https://www.'), "s_nationkey", F.lit(".example/x,"), key),
        F.concat(name, F.lit(",,"), key + 1),
        F.lit("Language,,English"),
        F.concat(F.lit("Region,,Middle East "), "s_nationkey"),
        F.lit("Date,,06/16/2024 to 06/30/2024"),
        F.concat(F.lit("Text,,"), F.when(key % 4 == 0, F.concat(F.lit('"bread, Text, wheat '), key, F.lit('"'))).otherwise("")),
        F.concat(F.lit('Results Found,,"'), F.format_number(1000 + key, 0), F.lit('"')),
        *[F.lit(x) for x in _FOOTER_FILL],
    ]
    files = table(spark, directory, "supplier").select("s_suppkey", F.concat_ws("\n", *lines).alias("text"))
    return E.parse_export(files)


@query(
    "headline_extract",
    """WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    marked AS (
      SELECT doc_id, list_transform(list_filter(lines, lambda x: contains(x, ' of ')),
          lambda x: trim(string_split(x, ',')[1])) AS heads,
        list_filter(lines, lambda x: contains(x, ' the ')) AS metas FROM cut),
    paired AS (SELECT doc_id, unnest(range(len(heads))) AS position, heads, metas FROM marked),
    parts AS (SELECT doc_id, position, heads[position + 1] AS headline, string_split(metas[position + 1], ',') AS p FROM paired)
    SELECT doc_id, CAST(position AS INTEGER) AS position, headline,
      CASE WHEN len(p) IN (4, 5) THEN p[1] END AS source, CASE WHEN len(p) IN (4, 5) THEN p[3] END AS date
    FROM parts""",
)
def headline_extract(spark, directory):
    files = table(spark, directory, "documents").select("doc_id", "text")
    return E.extract_headlines(files, " of ", " the ", cut_at=",")


@query(
    "new_files_anti_join",
    """WITH listing AS (
      SELECT 'news_' || doc_id || CASE lang WHEN 'en' THEN '_eng' WHEN 'fr' THEN '_ara' ELSE '' END || '.csv' AS file FROM documents),
    done AS (
      SELECT 'news_' || doc_id || CASE lang WHEN 'en' THEN '_eng' WHEN 'fr' THEN '_ara' ELSE '' END || '_counts_per_day.csv' AS file
      FROM documents JOIN labels USING (doc_id))
    SELECT file, replace(file, '.csv', '_counts_per_day.csv') AS output,
      CASE WHEN contains(file, 'eng') THEN 'English' ELSE 'Arabic' END AS language
    FROM listing WHERE replace(file, '.csv', '_counts_per_day.csv') NOT IN (SELECT file FROM done)
      AND (contains(file, 'eng') OR contains(file, 'ara'))""",
)
def new_files_anti_join(spark, directory):
    tag = F.when(F.col("lang") == "en", "_eng").when(F.col("lang") == "fr", "_ara").otherwise("")
    stem = F.concat(F.lit("news_"), "doc_id", tag)
    documents = table(spark, directory, "documents").select("doc_id", stem.alias("stem"))
    labels = table(spark, directory, "labels").select("doc_id")
    listing = documents.select(F.concat("stem", F.lit(".csv")).alias("file"))
    done = documents.join(labels, "doc_id").select(F.concat("stem", F.lit("_counts_per_day.csv")).alias("file"))
    return monthly.new_files(listing, done, "counts_per_day")


@query(
    "merge_daily",
    f"""WITH {X.SQL_MENTIONS}
    SELECT date, location, count(DISTINCT article_id) AS count_articles FROM loc GROUP BY date, location""",
)
def merge_daily(spark, directory):
    # Each language's files give daily rows of their own; merging adds them up per date and place.
    appended = D.location_counts(daily_sets(spark, directory, ("date", "lang")), ("date", "lang"))
    return monthly.merge_daily(appended, [D.ARTICLES], ["date", "location"])
