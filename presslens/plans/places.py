"""Gazetteer, spellings, keyword table; regions, nations and customers play the three levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions import names as N
from presslens.operators import gazetteer as G
from presslens.operators import keywords as K
from presslens.operators import lookups as L
from presslens.operators import mentions as M
from presslens.operators import ranking
from presslens.operators import rollups as R
from presslens.operators import stats as S
from presslens.operators.sizing import cut_lineage
from presslens.plans.registry import query
from presslens.plans.tables import rows, sql_values, table

_SQL_PLACES = """places AS (
  SELECT 0 AS level, 'R' || r_regionkey AS code_0, CAST(NULL AS VARCHAR) AS code_1,
    lower(r_name) AS nam_0, CAST(NULL AS VARCHAR) AS nam_1, CAST(NULL AS VARCHAR) AS nam_2,
    CAST(0 AS BIGINT) AS src_order
  FROM region
  UNION ALL
  SELECT 1, 'R' || r_regionkey, 'R' || r_regionkey || '.N' || n_nationkey, lower(r_name), lower(n_name),
    NULL, 0
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 2, 'R' || r_regionkey, 'R' || r_regionkey || '.N' || n_nationkey, lower(r_name), lower(n_name),
    lower(c_name), c_custkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def places(spark, directory):
    """The three levels in one table."""
    region = table(spark, directory, "region")
    nation = table(spark, directory, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, directory, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    none = F.lit(None).cast("string")
    code_0 = F.concat(F.lit("R"), "r_regionkey").alias("code_0")
    code_1 = F.concat(F.lit("R"), "r_regionkey", F.lit(".N"), "n_nationkey").alias("code_1")
    nam_0 = F.lower("r_name").alias("nam_0")
    nam_1 = F.lower("n_name").alias("nam_1")
    zero = F.lit(0).cast("long").alias("src_order")
    parts = [
        region.select(
            F.lit(0).alias("level"), code_0, none.alias("code_1"), nam_0,
            none.alias("nam_1"), none.alias("nam_2"), zero,
        ),
        nation.select(F.lit(1).alias("level"), code_0, code_1, nam_0, nam_1, none.alias("nam_2"), zero),
        customer.select(
            F.lit(2).alias("level"), code_0, code_1, nam_0, nam_1,
            F.lower("c_name").alias("nam_2"), F.col("c_custkey").alias("src_order"),
        ),
    ]
    return L.aligned_union(parts)


# Provinces whose id is set by hand.
_FIXED_IDS = [("nation_3", "R3_XX"), ("nation_7", "R2_YY")]
_SQL_IDS = f"""{_SQL_PLACES},
fixed(nam_1, fixed_id) AS (VALUES {sql_values(_FIXED_IDS)}),
coded AS (
  SELECT places.*, lower(code_0) AS id_0, lower(coalesce(fixed_id, replace(code_1, '.', '_'))) AS id_1
  FROM places LEFT JOIN fixed USING (nam_1)),
ids AS (
  SELECT *, CASE WHEN level = 2 THEN
    id_1 || '_' || row_number() OVER (PARTITION BY level, id_1 ORDER BY src_order) END AS id_2
  FROM coded)"""


def _ids(spark, directory):
    fixed = rows(spark, "nam_1, fixed_id", _FIXED_IDS)
    return G.hierarchy_ids(places(spark, directory), "src_order", fixed)


@query("running_id", f"WITH {_SQL_IDS} SELECT level, nam_0, nam_1, nam_2, id_0, id_1, id_2 FROM ids")
def running_id(spark, directory):
    return _ids(spark, directory).select("level", "nam_0", "nam_1", "nam_2", "id_0", "id_1", "id_2")


@query(
    "level_coalesce",
    f"""WITH {_SQL_IDS}
    SELECT level, CASE level WHEN 0 THEN nam_0 WHEN 1 THEN nam_1 ELSE nam_2 END AS name,
      CASE level WHEN 0 THEN id_0 WHEN 1 THEN id_1 ELSE id_2 END AS id FROM ids""",
)
def level_coalesce(spark, directory):
    return G.level_columns(_ids(spark, directory)).select("level", "name", "id")


# New provinces of the country that is pushed down a level.
_PARENTS = [(f"nation_{i}", "west" if i < 12 else "east") for i in range(25)]


@query(
    "relevel_hierarchy",
    f"""WITH {_SQL_PLACES},
    parents(nam_2, parent) AS (VALUES {sql_values(_PARENTS)})
    SELECT level, nam_0, nam_1, nam_2 FROM places WHERE nam_0 <> 'asia' OR level = 0
    UNION ALL
    SELECT 2, nam_0, parent, nam_1 FROM places LEFT JOIN parents ON parents.nam_2 = places.nam_1
    WHERE nam_0 = 'asia' AND level = 1
    UNION ALL
    SELECT 1, nam_0, parent, NULL FROM places, (SELECT DISTINCT parent FROM parents)
    WHERE nam_0 = 'asia' AND level = 0""",
)
def relevel_hierarchy(spark, directory):
    parents = rows(spark, "nam_2, parent", _PARENTS)
    moved = G.relevel_country(places(spark, directory), "asia", parents)
    return moved.select("level", "nam_0", "nam_1", "nam_2")


@query(
    "gazetteer_inner",
    f"""WITH {_SQL_PLACES}
    SELECT s_suppkey, lower(n_name) AS nam_1, nam_0, code_1
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN (SELECT * FROM places WHERE level = 1 AND nam_0 <> 'america') p ON p.nam_1 = lower(n_name)""",
)
def gazetteer_inner(spark, directory):
    supplier, nation = table(spark, directory, "supplier"), table(spark, directory, "nation")
    named = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.lower("n_name").alias("nam_1")
    )
    provinces = places(spark, directory).where("level = 1 AND nam_0 <> 'america'")
    return named.join(provinces.select("nam_1", "nam_0", "code_1"), "nam_1")


@query(
    "gazetteer_right_unmatched",
    """SELECT c_custkey, c_name, n_orders, CAST(n_orders IS NULL AS INTEGER) AS unmatched
       FROM (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
       RIGHT JOIN customer USING (c_custkey)""",
)
def gazetteer_right_unmatched(spark, directory):
    orders = table(spark, directory, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, directory, "customer").select("c_custkey", "c_name")
    return L.right_with_unmatched(orders.agg(F.count("*").alias("n_orders")), customers, "c_custkey")


@query(
    "gazetteer_full_indicator",
    f"""WITH {_SQL_PLACES},
    wiki AS (SELECT level, nam_0 AS country, coalesce(nam_2, nam_1, nam_0) AS location_name,
      'http://x/' || coalesce(nam_2, nam_1, nam_0) AS uri FROM places WHERE nam_0 <> 'africa'),
    gaz AS (SELECT level, nam_0 AS country, coalesce(nam_2, nam_1, nam_0) AS location_name, code_1
      FROM places WHERE nam_0 <> 'europe')
    SELECT level, country, location_name, uri, code_1,
      CASE WHEN g.country IS NULL THEN 'left_only' WHEN w.country IS NULL THEN 'right_only' ELSE 'both' END AS exist
    FROM (SELECT * FROM wiki) w FULL JOIN gaz g USING (level, country, location_name)""",
)
def gazetteer_full_indicator(spark, directory):
    name = F.coalesce("nam_2", "nam_1", "nam_0").alias("location_name")
    named = places(spark, directory).select("level", F.col("nam_0").alias("country"), name, "code_1")
    wiki = named.where("country <> 'africa'").select(
        "level", "country", "location_name", F.concat(F.lit("http://x/"), "location_name").alias("uri")
    )
    keys = ["level", "country", "location_name"]
    return L.full_with_indicator(wiki, named.where("country <> 'europe'"), keys)


# Names as scraped: the part table in shapes that need cleaning.
@query(
    "strip_articles",
    "SELECT p_partkey, name, "
    + "".join(["regexp_replace("] * len(N.ARTICLES))
    + "name"
    + "".join(f", '^{a}', '')" for a in N.ARTICLES)
    + """ AS stripped
    FROM (SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'al-ar ' WHEN 1 THEN 'ath-' WHEN 2 THEN 'as as '
      WHEN 3 THEN 'el ' WHEN 4 THEN 'an-al-' WHEN 5 THEN 'ar-' ELSE '' END || p_name AS name FROM part)""",
)
def strip_articles(spark, directory):
    kind = F.col("p_size") % 7
    prefixes = ["al-ar ", "ath-", "as as ", "el ", "an-al-", "ar-"]
    prefix = F.lit("")
    for i, text in enumerate(prefixes):
        prefix = F.when(kind == i, text).otherwise(prefix)
    named = table(spark, directory, "part").select("p_partkey", F.concat(prefix, "p_name").alias("name"))
    return named.withColumn("stripped", N.strip_articles(F.col("name")))


def _aliased(spark, directory):
    size, name = F.col("p_size"), F.col("p_name")
    return table(spark, directory, "part").select(
        "p_partkey",
        F.when(size != 9, name).alias("nam"),
        F.when(size % 3 == 0, name).when(size % 3 == 1, F.concat(name, F.lit(" a"))).alias("gaul"),
        F.when(size % 4 == 0, F.concat(name, F.lit(" a"))).when(size % 4 == 1, F.concat(name, F.lit(" b"))).alias("srce"),
        F.when(size % 5 == 0, F.concat(name, F.lit(" b"))).when(size % 5 == 1, F.concat(name, F.lit(" a")))
        .when(size % 5 == 2, name).alias("wiki"),
    )


@query(
    "consolidate_aliases",
    """WITH raw AS (
      SELECT p_partkey, CASE WHEN p_size <> 9 THEN p_name END AS nam,
        CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' a' END AS gaul,
        CASE p_size % 4 WHEN 0 THEN p_name || ' a' WHEN 1 THEN p_name || ' b' END AS srce,
        CASE p_size % 5 WHEN 0 THEN p_name || ' b' WHEN 1 THEN p_name || ' a' WHEN 2 THEN p_name END AS wiki
      FROM part),
    blank AS (SELECT p_partkey, nam, CASE WHEN gaul IS DISTINCT FROM nam THEN gaul END AS g,
      CASE WHEN srce IS DISTINCT FROM nam THEN srce END AS s, CASE WHEN wiki IS DISTINCT FROM nam THEN wiki END AS w
      FROM raw),
    one AS (SELECT *, coalesce(g, s, w) AS alias_1 FROM blank)
    SELECT p_partkey, nam, alias_1,
      CASE WHEN w IS DISTINCT FROM alias_1 AND w IS DISTINCT FROM s THEN w END AS alias_2 FROM one""",
)
def consolidate_aliases(spark, directory):
    folded = G.consolidate_aliases(
        _aliased(spark, directory), "nam", ["gaul", "srce", "wiki"], "wiki", against=["srce"]
    )
    return folded.select("p_partkey", "nam", "alias_1", "alias_2")


_SQL_CLEAN = "trim(" + "".join(["replace("] * (len(N.UNIT_WORDS) + 1)) + "lower(n), '  ', ' ')"
_SQL_CLEAN += "".join(f", '{w}', '')" for w in N.UNIT_WORDS) + ")"
_SQL_STRIPPED = "".join(["regexp_replace("] * len(N.ARTICLES)) + _SQL_CLEAN
_SQL_STRIPPED += "".join(f", '^{a}', '')" for a in N.ARTICLES)


@query(
    "clean_names",
    f"""WITH raw AS (
      SELECT p_partkey, unnest([p_name || ' District', 'AL-' || upper(p_name) || '  Governorate', '123',
        'province', 'Markaz  ' || p_type, p_name]) AS n FROM part)
    SELECT DISTINCT p_partkey, {_SQL_STRIPPED} AS name FROM raw
    WHERE regexp_matches(n, '[a-zA-Z]') AND {_SQL_CLEAN} <> ''""",
)
def clean_names(spark, directory):
    name = F.col("p_name")
    raw = table(spark, directory, "part").select(
        "p_partkey",
        F.array(
            F.concat(name, F.lit(" District")),
            F.concat(F.lit("AL-"), F.upper(name), F.lit("  Governorate")),
            F.lit("123"),
            F.lit("province"),
            F.concat(F.lit("Markaz  "), "p_type"),
            name,
        ).alias("names"),
    )
    return G.candidate_names(raw, "names")


_SQL_NAMES = """names AS (
  SELECT DISTINCT p_brand, p_name AS name FROM part
  UNION SELECT p_brand, p_name || ' city' FROM part WHERE p_size < 5
  UNION SELECT p_brand, split_part(p_name, ' ', 2) FROM part WHERE p_size = 7
  UNION SELECT p_brand, 'of ' || p_name || ' and the old town by a wide river ' || p_type FROM part WHERE p_size = 9)"""


def _brand_names(spark, directory):
    part = table(spark, directory, "part").select("p_brand", "p_name", "p_size", "p_type")
    long = F.concat(
        F.lit("of "), "p_name", F.lit(" and the old town by a wide river "), "p_type"
    )
    variants = F.array_compact(
        F.array(
            F.col("p_name"),
            F.when(F.col("p_size") < 5, F.concat("p_name", F.lit(" city"))),
            F.when(F.col("p_size") == 7, F.split_part("p_name", F.lit(" "), F.lit(2))),
            F.when(F.col("p_size") == 9, long),
        )
    )
    return part.select("p_brand", F.explode(variants).alias("name")).distinct()


@query(
    "prune_superset_names",
    f"""WITH {_SQL_NAMES}
    SELECT p_brand, name FROM names a WHERE NOT EXISTS (
      SELECT 1 FROM names b WHERE a.p_brand = b.p_brand
        AND list_has_all(string_split(a.name, ' '), string_split(b.name, ' '))
        AND len(list_distinct(string_split(b.name, ' '))) < len(list_distinct(string_split(a.name, ' '))))""",
)
def prune_superset_names(spark, directory):
    return G.prune_supersets(cut_lineage(_brand_names(spark, directory)), "p_brand", "name")


@query(
    "strip_brackets",
    """SELECT c_custkey, trim(regexp_replace(replace(replace(c_mktsegment || ' (' || c_name || ')  x, iraq or', ', iraq', ''),
         ' or', ''), '\\(.*?\\)', '', 'g')) AS name FROM customer""",
)
def strip_brackets(spark, directory):
    raw = F.concat("c_mktsegment", F.lit(" ("), "c_name", F.lit(")  x, iraq or"))
    return table(spark, directory, "customer").select(
        "c_custkey", N.strip_phrases(raw, [", iraq", " or"]).alias("name")
    )


@query(
    "bracket_alias",
    """SELECT p_partkey, CASE WHEN p_size < 25 THEN p_brand ELSE p_name END AS name,
         'district ' || CASE WHEN p_size < 25 THEN p_brand ELSE p_name END AS unit_name FROM part""",
)
def bracket_alias(spark, directory):
    raw = F.when(
        F.col("p_size") < 25, F.concat("p_name", F.lit("["), "p_brand", F.lit("]"))
    ).otherwise(F.col("p_name"))
    named = table(spark, directory, "part").select("p_partkey", N.bracket_alias(raw).alias("name"))
    return named.withColumn("unit_name", F.concat(F.lit("district "), "name"))


@query(
    "name_word_frequency",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word",
)
def name_word_frequency(spark, directory):
    return M.name_word_frequency(table(spark, directory, "part"), "p_name")


@query("value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def value_counts(spark, directory):
    return S.value_counts(table(spark, directory, "part"), ["p_brand"])


@query(
    "propagate_unique_id",
    """WITH raw AS (
      SELECT s_suppkey, 'uri' || s_nationkey AS uri,
        CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_nationkey % 4 = 0 THEN 'id' || s_nationkey || '_' || s_suppkey % 2
          ELSE 'id' || s_nationkey END AS id FROM supplier)
    SELECT s_suppkey, uri, coalesce(id, CASE WHEN min(CASE WHEN id <> 'id8_0' THEN id END) OVER w
        = max(CASE WHEN id <> 'id8_0' THEN id END) OVER w
      THEN min(CASE WHEN id <> 'id8_0' THEN id END) OVER w END) AS id
    FROM raw WINDOW w AS (PARTITION BY uri)""",
)
def propagate_unique_id(spark, directory):
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    raw = table(spark, directory, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("uri"), nation).alias("uri"),
        F.when(key % 3 == 0, F.lit(None))
        .when(nation % 4 == 0, F.concat(F.lit("id"), nation, F.lit("_"), key % 2))
        .otherwise(F.concat(F.lit("id"), nation))
        .alias("id"),
    )
    return G.propagate_unique_id(raw, "uri", "id", masked_id="id8_0")


@query(
    "assign_missing_ids",
    """WITH raw AS (
      SELECT c_custkey, 'n' || c_nationkey AS country, 'uri' || (c_custkey // 2) AS uri,
        CASE WHEN c_acctbal >= 0 THEN 'id' || c_custkey END AS id FROM customer),
    new AS (SELECT country, uri, country || '_00_' || (row_number() OVER (PARTITION BY country ORDER BY uri) - 1) AS new_id
      FROM (SELECT DISTINCT country, uri FROM raw WHERE id IS NULL))
    SELECT c_custkey, country, uri, coalesce(new_id, id) AS id FROM raw LEFT JOIN new USING (country, uri)""",
)
def assign_missing_ids(spark, directory):
    raw = table(spark, directory, "customer").select(
        "c_custkey",
        F.concat(F.lit("n"), "c_nationkey").alias("country"),
        F.concat(F.lit("uri"), F.floor(F.col("c_custkey") / 2)).alias("uri"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("id"), "c_custkey")).alias("id"),
    )
    return G.assign_missing_ids(raw, "country", "uri", "id")


# Names that are set by hand.
_DISPLAY = [("Brand#7", "The Seventh")]


@query(
    "display_names",
    f"""SELECT p_brand AS entity_id, coalesce(o.display_name, array_to_string(list_transform(
        string_split(arg_min(p_name, p_partkey), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')) AS display_name
      FROM part LEFT JOIN (VALUES {sql_values(_DISPLAY)}) o(entity_id, display_name) ON o.entity_id = p_brand
      GROUP BY p_brand, o.display_name""",
)
def display_names(spark, directory):
    variants = table(spark, directory, "part").select(
        F.col("p_brand").alias("entity_id"),
        F.col("p_name").alias("variant"),
        F.col("p_partkey").alias("position"),
    )
    return R.display_names(variants, rows(spark, "entity_id, display_name", _DISPLAY))


@query(
    "forward_fill",
    """WITH raw AS (
      SELECT p_partkey, CASE WHEN p_size > 40 THEN p_brand END AS brand,
        CASE WHEN p_size % 9 = 0 THEN p_type END AS kind FROM part)
    SELECT p_partkey, last_value(brand IGNORE NULLS) OVER w AS brand, last_value(kind IGNORE NULLS) OVER w AS kind
    FROM raw WINDOW w AS (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_fill(spark, directory):
    raw = table(spark, directory, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") % 9 == 0, F.col("p_type")).alias("kind"),
    )
    return ranking.forward_fill(raw, ["brand", "kind"], [F.col("p_partkey")])


# Aliases; one without a canonical name, one listed twice.
_ALIASES = [
    ("northland", "nation_3"),
    ("old northland", "nation_3"),
    ("southland", "nation_11"),
    ("southland", "nation_11"),
    ("nowhere", None),
]
_SQL_ALIASES = """names AS (
  SELECT level, nam_0 AS country, coalesce(nam_2, nam_1, nam_0) AS location_name,
    upper(coalesce(nam_2, nam_1, nam_0)) AS location_name_ara,
    'http://x/' || coalesce(nam_1, nam_0) AS uri FROM places)"""


def _place_names(spark, directory):
    name = F.coalesce("nam_2", "nam_1", "nam_0")
    return places(spark, directory).select(
        "level",
        F.col("nam_0").alias("country"),
        name.alias("location_name"),
        F.upper(name).alias("location_name_ara"),
        F.concat(F.lit("http://x/"), F.coalesce("nam_1", "nam_0")).alias("uri"),
    )


@query(
    "alias_expansion",
    f"""WITH {_SQL_PLACES}, {_SQL_ALIASES},
    aliases(alias, canonical) AS (VALUES {sql_values(_ALIASES)})
    SELECT * FROM names
    UNION SELECT level, country, alias, location_name_ara, uri
    FROM names JOIN aliases ON location_name = canonical WHERE level = 1""",
)
def alias_expansion(spark, directory):
    aliases = rows(spark, "alias, canonical", _ALIASES)
    return G.expand_aliases(_place_names(spark, directory), aliases, 1, "location_name")


# Addresses set by hand; an empty one takes the place out.
_URIS = [("nation_5", "http://y/five"), ("customer#000000004", ""), ("customer#000000009", "http://y/nine")]


@query(
    "query_specifications",
    f"""WITH {_SQL_PLACES}, {_SQL_ALIASES},
    overrides(location_name, override) AS (VALUES {sql_values(_URIS)}),
    set_ AS (SELECT level, country, location_name, location_name_ara, coalesce(override, uri) AS uri
      FROM names LEFT JOIN overrides USING (location_name))
    SELECT DISTINCT CASE WHEN level <> 2 THEN location_name END AS location_name, uri,
      CASE WHEN level <> 2 THEN location_name_ara END AS location_name_ara, country, level
    FROM set_ WHERE NOT (level = 2 AND coalesce(uri, '') = '')""",
)
def query_specifications(spark, directory):
    overrides = rows(spark, "location_name, override", _URIS)
    return G.query_specifications(_place_names(spark, directory), overrides)


_SQL_MATCHED = f"""{_SQL_IDS},
matched AS (
  SELECT CASE level WHEN 0 THEN id_0 WHEN 1 THEN id_1 ELSE id_2 END AS id,
    CASE WHEN src_order % 2 = 0 THEN 'al-' || coalesce(nam_2, nam_1, nam_0) END AS location_name,
    coalesce(nam_2, nam_1, nam_0) || CASE WHEN src_order % 5 = 1 THEN ' city' ELSE '' END AS name,
    'old ' || nam_1 AS nam_1_al1, CAST(NULL AS VARCHAR) AS nam_1_al2,
    CASE WHEN src_order % 3 = 0 THEN 'el ' || nam_2 || ' town' END AS nam_2_al1, upper(nam_2) AS nam_2_al2,
    CASE WHEN src_order % 2 = 0 THEN 'ا' || coalesce(nam_2, nam_1, nam_0) END AS location_name_ara,
    'ا' || coalesce(nam_2, nam_1, nam_0) AS name_ntve
  FROM ids)"""
_SQL_STRIP_V = "".join(["regexp_replace("] * len(N.ARTICLES)) + "v"
_SQL_STRIP_V += "".join(f", '^{a}', '')" for a in N.ARTICLES)


@query(
    "location_dictionary",
    f"""WITH {_SQL_MATCHED},
    listed AS (
      SELECT id, unnest([location_name, name,
        CASE len(string_split(id, '_')) WHEN 2 THEN nam_1_al1 WHEN 3 THEN nam_2_al1 END,
        CASE len(string_split(id, '_')) WHEN 2 THEN nam_1_al2 WHEN 3 THEN nam_2_al2 END]) AS v FROM matched),
    latin AS (SELECT DISTINCT id, {_SQL_STRIP_V} AS variant FROM listed WHERE v IS NOT NULL),
    arabic AS (SELECT DISTINCT id, unnest([location_name_ara, name_ntve]) AS variant FROM matched)
    SELECT id AS entity_id, 'eng' AS lang, variant FROM latin a WHERE NOT EXISTS (
      SELECT 1 FROM latin b WHERE a.id = b.id
        AND list_has_all(string_split(a.variant, ' '), string_split(b.variant, ' '))
        AND len(list_distinct(string_split(b.variant, ' '))) < len(list_distinct(string_split(a.variant, ' '))))
    UNION ALL SELECT id, 'ara', variant FROM arabic WHERE variant IS NOT NULL""",
)
def location_dictionary(spark, directory):
    named = _ids(spark, directory).withColumn("_n", F.coalesce("nam_2", "nam_1", "nam_0"))
    order = F.col("src_order")
    matched = G.level_columns(named).select(
        "id",
        F.when(order % 2 == 0, F.concat(F.lit("al-"), "_n")).alias("location_name"),
        F.concat("_n", F.when(order % 5 == 1, " city").otherwise("")).alias("name"),
        F.concat(F.lit("old "), "nam_1").alias("nam_1_al1"),
        F.lit(None).cast("string").alias("nam_1_al2"),
        F.when(order % 3 == 0, F.concat(F.lit("el "), "nam_2", F.lit(" town"))).alias("nam_2_al1"),
        F.upper("nam_2").alias("nam_2_al2"),
        F.when(order % 2 == 0, F.concat(F.lit("ا"), "_n")).alias("location_name_ara"),
        F.concat(F.lit("ا"), "_n").alias("name_ntve"),
    )
    return G.location_dictionary(matched)


# Category of a keyword by its first word; the others have none.
_CLUSTERS = [
    ("red", "Food crisis"),
    ("blue", "conflicts and violence"),
    ("hot", "LAND-related issues"),
    ("small", "Economic Issues"),
]
_OLD_ROWS = 150
_SQL_KEYWORDS = f"""translations AS (
  SELECT p_partkey AS position, ' ' || upper(p_name) || ' ' AS english,
    CASE WHEN p_size % 4 <> 0 THEN 'ع ' || p_name || ' ' END AS arabic FROM part),
by_word(word, cluster) AS (VALUES {sql_values(_CLUSTERS)}),
clusters AS (
  SELECT DISTINCT ' ' || upper(p_name) || ' ' AS keyword, cluster
  FROM part JOIN by_word ON word = split_part(p_name, ' ', 1)),
joined AS (SELECT position, english, arabic, cluster FROM translations LEFT JOIN clusters ON english = keyword),
filled AS (
  SELECT position, last_value(english IGNORE NULLS) OVER w AS english,
    last_value(arabic IGNORE NULLS) OVER w AS arabic,
    coalesce(CASE WHEN position < {_OLD_ROWS} THEN last_value(cluster IGNORE NULLS) OVER w ELSE cluster END,
      'New Category') AS cluster
  FROM joined WINDOW w AS (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
codes(group_name, code) AS (VALUES {sql_values(list(K.CATEGORY_CODES.items()))}),
grouped AS (
  SELECT lower(trim(english)) AS keyword_eng, trim(arabic) AS keyword_ara, array_to_string(list_transform(
    string_split(cluster, ' '), lambda w: CASE w WHEN 'and' THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS group_name
  FROM filled),
identified AS (
  SELECT grouped.*, code || '_' || replace(keyword_eng, ' ', '_') AS column_name
  FROM grouped LEFT JOIN codes USING (group_name)),
keyword_table AS (
  SELECT * FROM identified
  UNION ALL SELECT keyword_eng, keyword_ara, 'Any Keyword', column_name FROM identified
  UNION ALL SELECT NULL, NULL, group_name, code FROM codes)"""


def _keyword_table(spark, directory):
    part = table(spark, directory, "part")
    english = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))
    translations = part.select(
        F.col("p_partkey").alias("position"),
        english.alias("english"),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("ع "), "p_name", F.lit(" "))).alias("arabic"),
    )
    by_word = rows(spark, "word, cluster", _CLUSTERS)
    words = part.select(english.alias("keyword"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    clusters = words.distinct().join(by_word, "word").select("keyword", "cluster")
    return K.keyword_table(translations, clusters, _OLD_ROWS)


@query("keyword_table", f"WITH {_SQL_KEYWORDS} SELECT * FROM keyword_table")
def keyword_table(spark, directory):
    return _keyword_table(spark, directory)


@query(
    "keyword_dictionary",
    f"""WITH {_SQL_KEYWORDS}
    SELECT 'eng' AS lang, column_name AS entity_id,
      array_to_string(list_sort(list(DISTINCT keyword_eng)), '|') AS variants
    FROM keyword_table WHERE keyword_eng IS NOT NULL GROUP BY column_name
    UNION ALL
    SELECT 'ara', column_name, array_to_string(list_sort(list(DISTINCT keyword_ara)), '|')
    FROM keyword_table WHERE keyword_ara IS NOT NULL GROUP BY column_name""",
)
def keyword_dictionary(spark, directory):
    made = _keyword_table(spark, directory)

    def spelled(lang):
        found = K.keyword_dictionary(made, lang)
        return found.select(
            F.lit(lang).alias("lang"), "entity_id", F.array_join("variants", "|").alias("variants")
        )

    return spelled("eng").unionByName(spelled("ara"))


_SQL_VARIANTS = """variants AS (
  SELECT DISTINCT p_brand || '_' || replace(p_name, ' ', '_') AS entity_id, p_name AS variant FROM part)"""


def _part_variants(spark, directory):
    return table(spark, directory, "part").select(
        F.lit("keyword").alias("kind"),
        F.concat("p_brand", F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("entity_id"),
        F.col("p_name").alias("variant"),
    )


@query(
    "vocabulary_stats",
    f"""WITH {_SQL_VARIANTS}
    SELECT count(DISTINCT variant) AS n_spellings,
      CAST(max(len(string_split(variant, ' '))) AS INTEGER) AS max_ngram FROM variants""",
)
def vocabulary_stats(spark, directory):
    return M.vocabulary_stats(_part_variants(spark, directory))


@query(
    "category_map",
    f"""WITH {_SQL_VARIANTS}
    SELECT DISTINCT split_part(entity_id, '_', 1) AS category, entity_id FROM variants
    UNION ALL SELECT 'kw', 'kw_all'""",
)
def category_map(spark, directory):
    return M.category_map(_part_variants(spark, directory))


@query(
    "dictionary_parity",
    """WITH eng AS (SELECT DISTINCT p_brand || '_' || p_name AS entity_id FROM part WHERE p_size < 30),
    ara AS (SELECT DISTINCT p_brand || '_' || p_name AS entity_id FROM part WHERE p_size > 20)
    SELECT entity_id, 'ara' AS missing_in FROM eng WHERE entity_id NOT IN (SELECT entity_id FROM ara)
    UNION ALL
    SELECT entity_id, 'eng' FROM ara WHERE entity_id NOT IN (SELECT entity_id FROM eng)""",
)
def dictionary_parity(spark, directory):
    part = table(spark, directory, "part").withColumn(
        "entity_id", F.concat("p_brand", F.lit("_"), "p_name")
    )
    return L.missing_ids(part.where("p_size < 30"), part.where("p_size > 20"), "entity_id", "eng", "ara")


_SQL_TEXT = "regexp_replace({}, '<[^>]*>', '', 'g')"
for _code, _sign in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&amp;": "&"}.items():
    _SQL_TEXT = f"replace({_SQL_TEXT}, '{_code}', '{_sign}')"


@query(
    "page_titles_bold",
    f"""WITH parts AS (
      SELECT page_id, url, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS h1,
        list_transform(string_split_regex(html, '<p(?:\\s[^>]*)?>')[2:3], lambda p: string_split(p, '</p>')[1]) AS ps
      FROM pages),
    bold AS (
      SELECT page_id, url, h1, flatten(list_transform(ps,
        lambda p: regexp_extract_all(p, '(?s)<(?:b|strong)>(.*?)</(?:b|strong)>', 1))) AS b FROM parts)
    SELECT url, {_SQL_TEXT.format("h1")} AS title,
      array_to_string(list_transform(b, lambda x: {_SQL_TEXT.format("x")}), '|') AS bold_names,
      CAST(NULL AS VARCHAR) AS title_other
    FROM bold""",
)
def page_titles_bold(spark, directory):
    found = G.page_names(table(spark, directory, "pages"))
    return found.select("url", "title", F.array_join("bold_names", "|").alias("bold_names"), "title_other")
