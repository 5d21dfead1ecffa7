"""News sources, providers and ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions import names as N
from presslens.operators import providers as P
from presslens.operators import search as Q
from presslens.operators import stats as S
from presslens.plans import fixtures as X
from presslens.plans.counting import daily_sets
from presslens.plans.registry import query
from presslens.plans.tables import rows, sql_values, table

_DOMAIN = """lower(string_split(replace(replace(replace(url, 'https://', ''), 'http://', ''),
  'www.', ''), '/')[1])"""


@query(
    "url_domain_counts",
    f"SELECT {_DOMAIN} AS domain, count(*) AS n FROM pages GROUP BY 1",
)
def url_domain_counts(spark, directory):
    domains = table(spark, directory, "pages").select(N.domain_of(F.col("url")).alias("domain"))
    return S.value_counts(domains, ["domain"])


@query(
    "source_frequency",
    """SELECT lower(source) AS title, lower(source || '.' || lang || '.example') AS uri,
         CAST(sum(n_chars) AS BIGINT) AS frequency FROM documents GROUP BY 1, 2""",
)
def source_frequency(spark, directory):
    documents = table(spark, directory, "documents").select(
        F.col("source").alias("title"),
        F.concat("source", F.lit("."), "lang", F.lit(".example")).alias("uri"),
        "n_chars",
    )
    return P.source_frequency(documents, ["title", "uri"], "n_chars", "frequency")


_SQL_PARTS = """parts AS (
  SELECT p_name AS title, lower(p_brand) || '/' || p_partkey AS uri, CAST(p_size AS BIGINT) AS frequency
  FROM part)"""


@query(
    "duplicate_title_suffix",
    f"""WITH {_SQL_PARTS}
    SELECT CASE WHEN count(*) OVER (PARTITION BY title) > 1 THEN title || ' (' ||
        row_number() OVER (PARTITION BY title ORDER BY frequency DESC, uri) || ')' ELSE title END AS title,
      uri, frequency FROM parts""",
)
def duplicate_title_suffix(spark, directory):
    parts = table(spark, directory, "part").select(
        F.col("p_name").alias("title"),
        F.concat(F.lower("p_brand"), F.lit("/"), F.col("p_partkey")).alias("uri"),
        F.col("p_size").cast("long").alias("frequency"),
    )
    return P.number_repeated_titles(parts)


@query(
    "top_sources_label",
    f"""WITH titled AS (
      SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {_DOMAIN} AS uri FROM pages),
    counted AS (SELECT title, uri, count(*) AS frequency FROM titled GROUP BY ALL)
    SELECT *, CASE WHEN length(title) > 45 THEN uri ELSE title END AS label FROM counted
    ORDER BY frequency DESC, title, uri LIMIT 10""",
)
def top_sources_label(spark, directory):
    titled = table(spark, directory, "pages").select(
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        N.domain_of(F.col("url")).alias("uri"),
    )
    return P.top_labelled(S.value_counts(titled, ["title", "uri"], "frequency"))


# Two providers: a has the English documents under numbered titles, b the other languages under plain
# names, some without an address. Names ending in 7 are spelled differently, so some do not match.
_SQL_PROVIDERS = """a AS (
  SELECT source || ' (1)' AS title, source || '.com' AS uri, count(*) AS frequency
  FROM documents WHERE lang = 'en' GROUP BY ALL),
b AS (
  SELECT CASE WHEN source LIKE '%7' THEN 'the ' || source ELSE source END AS source,
    CASE WHEN source LIKE '%1' THEN NULL WHEN source LIKE '%7' THEN source || '.net' ELSE source || '.com' END AS uri,
    count(*) AS document_count
  FROM documents WHERE lang <> 'en' GROUP BY ALL),
a_matched AS (
  SELECT *, CAST(uri IN (SELECT uri FROM b WHERE uri IS NOT NULL) AS INTEGER) AS uri_match,
    CAST(regexp_replace(title, '\\s*\\(\\d+\\)', '', 'g') IN (SELECT source FROM b) AS INTEGER) AS title_match FROM a),
b_matched AS (
  SELECT *, CAST(coalesce(uri IN (SELECT uri FROM a), false) AS INTEGER) AS uri_match,
    CAST(source IN (SELECT regexp_replace(title, '\\s*\\(\\d+\\)', '', 'g') FROM a) AS INTEGER) AS source_match FROM b)"""


def _providers(spark, directory):
    documents = table(spark, directory, "documents").select("source", "lang")
    source = F.col("source")
    a = documents.where("lang = 'en'").select(
        F.concat(source, F.lit(" (1)")).alias("title"), F.concat(source, F.lit(".com")).alias("uri")
    )
    odd = source.endswith("7")
    b = documents.where("lang <> 'en'").select(
        F.when(odd, F.concat(F.lit("the "), source)).otherwise(source).alias("source"),
        F.when(source.endswith("1"), F.lit(None))
        .when(odd, F.concat(source, F.lit(".net")))
        .otherwise(F.concat(source, F.lit(".com")))
        .alias("uri"),
    )
    return (
        a.groupBy("title", "uri").agg(F.count("*").alias("frequency")),
        b.groupBy("source", "uri").agg(F.count("*").alias("document_count")),
    )


@query(
    "source_match_flags",
    f"""WITH {_SQL_PROVIDERS}
    SELECT 'a' AS provider, title AS name, uri, frequency AS n, uri_match, title_match AS name_match,
      greatest(uri_match, title_match) AS matched FROM a_matched
    UNION ALL
    SELECT 'b', source, uri, document_count, uri_match, source_match,
      greatest(uri_match, source_match) FROM b_matched""",
)
def source_match_flags(spark, directory):
    a, b = P.match_sources(*_providers(spark, directory))
    left = a.select(
        F.lit("a").alias("provider"),
        F.col("title").alias("name"),
        "uri",
        F.col("frequency").alias("n"),
        "uri_match",
        F.col("title_match").alias("name_match"),
        "matched",
    )
    right = b.select(
        F.lit("b").alias("provider"),
        F.col("source").alias("name"),
        "uri",
        F.col("document_count").alias("n"),
        "uri_match",
        F.col("source_match").alias("name_match"),
        "matched",
    )
    return left.unionByName(right)


@query(
    "source_overlap_share",
    f"""WITH {_SQL_PROVIDERS},
    g AS (SELECT greatest(uri_match, source_match) AS matched, count(*) AS sources,
            CAST(sum(document_count) AS BIGINT) AS articles FROM b_matched GROUP BY 1)
    SELECT *, sources / CAST(sum(sources) OVER () AS DOUBLE) AS source_share,
      articles / CAST(sum(articles) OVER () AS DOUBLE) AS article_share FROM g""",
)
def source_overlap_share(spark, directory):
    _, b = P.match_sources(*_providers(spark, directory))
    return P.overlap_share(b, "document_count")


@query(
    "source_intersect",
    f"WITH {_SQL_PROVIDERS} SELECT uri FROM a INTERSECT SELECT uri FROM b WHERE uri IS NOT NULL",
)
def source_intersect(spark, directory):
    a, b = _providers(spark, directory)
    return a.select("uri").intersect(b.select("uri").dropna())


_SQL_RATED = f"""counted AS (
  SELECT CASE WHEN d LIKE 'm.%' THEN NULL ELSE d END AS uri,
    split_part(url, '://', 1) AS scheme, count(*) AS frequency
  FROM (SELECT {_DOMAIN} AS d, url FROM pages) GROUP BY ALL),
ratings AS (
  SELECT DISTINCT {_DOMAIN} AS domain, (length({_DOMAIN}) % 10) / 10.0::DOUBLE AS pc1 FROM pages
  WHERE {_DOMAIN} NOT LIKE '%.org'),
rated AS (SELECT * FROM counted LEFT JOIN ratings ON uri = domain)"""


def _rated(spark, directory):
    domain = N.domain_of(F.col("url"))
    pages = table(spark, directory, "pages").select("url", domain.alias("d"))
    counted = (
        pages.select(
            F.when(~F.col("d").startswith("m."), F.col("d")).alias("uri"),
            F.split_part("url", F.lit("://"), F.lit(1)).alias("scheme"),
        )
        .groupBy("uri", "scheme")
        .agg(F.count("*").alias("frequency"))
    )
    ratings = (
        pages.where(~F.col("d").endswith(".org"))
        .select(F.col("d").alias("domain"), ((F.length("d") % 10) / F.lit(10.0)).alias("pc1"))
        .distinct()
    )
    return P.join_ratings(counted, ratings)


@query("source_rating_join", f"WITH {_SQL_RATED} SELECT * FROM rated")
def source_rating_join(spark, directory):
    return _rated(spark, directory)


@query(
    "rating_coverage",
    f"""WITH {_SQL_RATED}
    SELECT count(*) AS sources, count(*) FILTER (uri IS NULL) AS without_uri,
      count(*) FILTER (pc1 IS NULL) AS without_rating FROM rated""",
)
def rating_coverage(spark, directory):
    return P.rating_coverage(_rated(spark, directory))


@query(
    "weighted_rating_quartiles",
    f"""WITH {_SQL_RATED},
    repeated AS (SELECT scheme, pc1, unnest(range(frequency)) AS i FROM rated WHERE pc1 IS NOT NULL)
    SELECT scheme, min(pc1) AS min, round(quantile_cont(pc1, 0.25), 9) AS q1,
      round(quantile_cont(pc1, 0.5), 9) AS median, round(quantile_cont(pc1, 0.75), 9) AS q3,
      max(pc1) AS max
    FROM repeated GROUP BY scheme""",
)
def weighted_rating_quartiles(spark, directory):
    quartiles = S.weighted_quartiles(_rated(spark, directory), "pc1", "frequency", "scheme")
    return quartiles.withColumns({c: F.round(c, 9) for c in ("q1", "median", "q3")})


@query(
    "provider_comparison",
    f"""WITH {X.SQL_MENTIONS},
    ids AS (SELECT DISTINCT entity_id AS k FROM dict WHERE kind = 'keyword'),
    prov(p) AS (VALUES ('a'), ('b'))
    SELECT p || '_' || k AS keyword, count(*) FILTER (location = 'xa') AS xa,
      count(*) FILTER (location = 'xb') AS xb
    FROM ids CROSS JOIN prov
    LEFT JOIN kw ON keyword = k AND (CASE WHEN kw.lang = 'en' THEN 'a' ELSE 'b' END) = p
    LEFT JOIN loc ON loc.article_id = kw.article_id
    GROUP BY p, k""",
)
def provider_comparison(spark, directory):
    sets = daily_sets(spark, directory, ("date", "lang"))

    def matrix(part):
        return Q.keyword_country_matrix(part, X.COUNTRIES, X.KEYWORD_IDS)

    parts = {"a": matrix(sets.where("lang = 'en'")), "b": matrix(sets.where("lang <> 'en'"))}
    return P.compare_providers(parts, "keyword")


# Places whose address is set by hand.
_OVERRIDES = [("Supplier#000000003", "place/three"), ("Supplier#000000007", "place/seven")]


@query(
    "agreeing_lookup",
    f"""WITH looked AS (
      SELECT s_name, 'place/' || s_nationkey AS concept_uri,
        CASE WHEN s_acctbal < 5000 THEN 'place/' || s_nationkey ELSE 'area/' || s_nationkey END AS location_uri
      FROM supplier)
    SELECT looked.*, coalesce(override, CASE WHEN concept_uri = location_uri THEN concept_uri END) AS uri
    FROM looked LEFT JOIN (VALUES {sql_values(_OVERRIDES)}) o(s_name, override) USING (s_name)""",
)
def agreeing_lookup(spark, directory):
    key = F.col("s_nationkey")
    place = F.concat(F.lit("place/"), key)
    looked = table(spark, directory, "supplier").select(
        "s_name",
        place.alias("concept_uri"),
        F.when(F.col("s_acctbal") < 5000, place)
        .otherwise(F.concat(F.lit("area/"), key))
        .alias("location_uri"),
    )
    overrides = rows(spark, "s_name, override", _OVERRIDES)
    return P.agreed_value(looked, "concept_uri", "location_uri", "s_name", overrides)
