"""Places: hierarchy, ids, names and spellings.

A place has a level (0 country, 1 province, 2 district) and the names of its country, province and
district in `nam_0`, `nam_1`, `nam_2`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import names as N
from presslens.operators import ranking
from presslens.operators.daily import level_of
from presslens.operators.sizing import cut_lineage

# Up to this many words of a name, its word subsets are listed to find the names it contains.
SUBSET_WORDS = 8


def by_level(level: Column, columns: list[Column]) -> Column:
    """The first, second or third column, for level 0, 1, 2."""
    return F.when(level == 0, columns[0]).when(level == 1, columns[1]).when(level == 2, columns[2])


def consolidate_aliases(
    df: DataFrame, main: str, first: list[str], second: str, against: list[str] = ()
) -> DataFrame:
    """Fold alias columns into `alias_1` and `alias_2`.

    Aliases equal to the main name are blanked. The first alias is the first of `first` that is left;
    the second one is `second` unless it repeats the first alias or one of the `against` columns.
    """
    name = F.col(main)

    def kept(column):
        return F.when(F.col(column) != name, F.col(column)).when(name.isNull(), F.col(column))

    one = F.coalesce(*[kept(c) for c in first])
    two = kept(second)
    for other in [one, *[kept(c) for c in against]]:
        two = F.when(two.eqNullSafe(other), F.lit(None)).otherwise(two)
    return df.withColumns({"alias_1": one, "alias_2": two})


def hierarchy_ids(
    places: DataFrame, order: str, fixed: DataFrame | None = None
) -> DataFrame:
    """Ids per level: `id_0`, `id_1` from the codes, `id_2` = province id + running number.

    `code_1` is a dotted code; `fixed` (`nam_1`, `fixed_id`) sets the id of provinces without one. The
    number counts the districts of a province in the order of the source, starting at 1.
    """
    code = F.replace("code_1", F.lit("."), F.lit("_"))
    if fixed is not None:
        places = places.join(fixed, "nam_1", "left")
        code = F.coalesce("fixed_id", code)
    coded = places.withColumns({"id_0": F.lower("code_0"), "id_1": F.lower(code)}).drop("fixed_id")
    districts = ranking.number_rows(
        coded.where("level = 2"), ["id_1"], [F.col(order)], "_number"
    )
    others = coded.where("level <> 2").withColumn("_number", F.lit(None).cast("long"))
    numbered = districts.unionByName(others)
    return numbered.withColumn("id_2", F.concat("id_1", F.lit("_"), F.col("_number"))).drop("_number")


def level_columns(places: DataFrame) -> DataFrame:
    """One `name` and one `id` column, taken from the columns of the place's own level."""
    level = F.col("level")
    return places.withColumns(
        {
            "name": by_level(level, [F.col(f"nam_{i}") for i in range(3)]),
            "id": by_level(level, [F.col(f"id_{i}") for i in range(3)]),
        }
    )


def relevel_country(places: DataFrame, country: str, parents: DataFrame) -> DataFrame:
    """Push the provinces of one country down to districts below new provinces.

    `parents` maps a former province (`nam_2`) to its new province (`parent`). The country's former
    districts go, its provinces become districts, and every new province gets a copy of the country row.
    """
    here = F.col("nam_0") == country
    rest = places.where(~here | (F.col("level") == 0))
    moved = places.where(here & (F.col("level") == 1)).withColumn("nam_2", F.col("nam_1"))
    moved = moved.join(parents, "nam_2", "left")
    moved = moved.withColumns({"level": F.lit(2), "nam_1": F.col("parent")}).drop("parent")
    provinces = parents.select("parent").distinct()
    added = places.where(here & (F.col("level") == 0)).withColumn("nam_0", F.lit(country))
    added = added.join(provinces.withColumn("nam_0", F.lit(country)), "nam_0")
    added = added.withColumns({"level": F.lit(1), "nam_1": F.col("parent")}).drop("parent")
    return rest.unionByName(moved).unionByName(added)


def candidate_names(df: DataFrame, names: str, target: str = "name") -> DataFrame:
    """One row per cleaned name of an array column."""
    return df.withColumn(target, F.explode(N.clean_names(F.col(names)))).drop(names)


def prune_supersets(df: DataFrame, key: str, name: str) -> DataFrame:
    """Drop a row whose name contains all the words of a shorter name of the same key.

    Nothing is collected per key and no pairs are made for ordinary names: the proper word subsets of a
    name are listed and looked up among the word sets of its key. Names of more than SUBSET_WORDS words
    are instead compared with the names whose first word they contain.
    """
    bag = F.array_sort(F.array_distinct(F.split(name, " ", -1)))
    rows = df.select(key, name, bag.alias("_bag")).withColumn("_k", F.size("_bag"))
    known = rows.select(F.col(key).alias("_key"), F.col("_bag").alias("_other")).distinct()

    def subset(mask):
        return F.filter("_bag", lambda _, i: F.getbit(mask, i) == 1)

    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.col("_k")) - 2).cast("int"))
    short = rows.where((F.col("_k") > 1) & (F.col("_k") <= SUBSET_WORDS))
    listed = short.select(key, name, F.explode(F.transform(masks, subset)).alias("_part"))
    same = (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_other"))
    contained = listed.join(known, same, "left_semi").select(key, name)
    long = rows.where(F.col("_k") > SUBSET_WORDS)
    long = long.select(key, name, F.col("_bag").alias("_whole"), F.explode("_bag").alias("_word"))
    heads = known.withColumn("_head", F.element_at("_other", 1))
    smaller = (F.size("_other") < F.size("_whole")) & (
        F.size(F.array_except("_other", "_whole")) == 0
    )
    meets = (F.col(key) == F.col("_key")) & (F.col("_word") == F.col("_head")) & smaller
    contained_long = long.join(heads, meets, "left_semi").select(key, name)
    drop = contained.unionByName(contained_long).distinct()
    return df.join(drop, [key, name], "left_anti")


def expand_aliases(names: DataFrame, aliases: DataFrame, level: int, target: str) -> DataFrame:
    """Add a copy of a canonical row under each of its aliases.

    `aliases` has (`alias`, `canonical`); an alias without a canonical name adds nothing, one listed
    twice adds one row. `target` is the column that takes the alias.
    """
    pairs = aliases.where("canonical IS NOT NULL").distinct()
    at_level = names.where(F.col("level") == level)
    copies = at_level.join(pairs, F.col("location_name") == F.col("canonical"))
    copies = copies.withColumn(target, F.col("alias")).drop("alias", "canonical")
    return names.unionByName(copies).distinct()


def propagate_unique_id(df: DataFrame, uri: str, id_: str, masked_id: str | None = None) -> DataFrame:
    """Give all rows of an address the id found there, when exactly one distinct id is.

    Rows of `masked_id` neither give nor take an id. The ids of an address are folded to their smallest
    and largest, so a very frequent address is aggregated map-side.
    """
    usable = F.col(id_).isNotNull() & F.col(uri).isNotNull()
    if masked_id is not None:
        usable = usable & (F.col(id_) != masked_id)
    found = df.where(usable).groupBy(F.col(uri).alias("_uri"))
    found = found.agg(F.min(id_).alias("_low"), F.max(id_).alias("_high"))
    single = found.where("_low = _high").select("_uri", F.col("_low").alias("_only"))
    joined = df.join(single, F.col(uri) == F.col("_uri"), "left")
    return joined.withColumn(id_, F.coalesce(id_, "_only")).drop("_uri", "_only")


def assign_missing_ids(df: DataFrame, country: str, uri: str, id_: str) -> DataFrame:
    """Number the addresses that have a row without an id: `cc_00_i` per country, in address order.

    All rows of such an address take the new id.
    """
    lacking = df.where(F.col(id_).isNull() & F.col(uri).isNotNull())
    lacking = lacking.select(F.col(country).alias("_cc"), F.col(uri).alias("_uri")).distinct()
    numbered = ranking.number_rows(lacking, ["_cc"], [F.col("_uri")], "_i")
    new = numbered.withColumn(
        "_new", F.concat("_cc", F.lit("_00_"), (F.col("_i") - 1).cast("string"))
    ).drop("_i")
    joined = df.join(new, (F.col(country) == F.col("_cc")) & (F.col(uri) == F.col("_uri")), "left")
    return joined.withColumn(id_, F.coalesce("_new", id_)).drop("_cc", "_uri", "_new")


def location_dictionary(matched: DataFrame) -> DataFrame:
    """Spellings per place id and language from the joined names and gazetteer.

    English: page names, main name and the two aliases of the place's own level, without leading
    articles and without names that contain another one. Arabic: page names and native name.
    """
    level = level_of(F.col("id"))
    english = F.array(
        F.col("location_name"),
        F.col("name"),
        F.when(level == 1, F.col("nam_1_al1")).when(level == 2, F.col("nam_2_al1")),
        F.when(level == 1, F.col("nam_1_al2")).when(level == 2, F.col("nam_2_al2")),
    )
    arabic = F.array(F.col("location_name_ara"), F.col("name_ntve"))

    def tagged(names, lang):
        return F.transform(names, lambda n: F.struct(F.lit(lang).alias("lang"), n.alias("variant")))

    listed = matched.where("id IS NOT NULL").select(
        F.col("id").alias("entity_id"),
        F.inline(F.concat(tagged(english, "eng"), tagged(arabic, "ara"))),
    )
    latin = F.col("lang") == "eng"
    stripped = F.when(latin, N.strip_articles(F.col("variant"))).otherwise(F.col("variant"))
    rows = cut_lineage(
        listed.where("variant IS NOT NULL").withColumn("variant", stripped).distinct()
    )
    pruned = prune_supersets(rows.where(latin), "entity_id", "variant")
    return pruned.unionByName(rows.where(~latin)).select("entity_id", "lang", "variant")


def query_specifications(names: DataFrame, overrides: DataFrame) -> DataFrame:
    """What to ask for per place: names above the district level, the address at that level.

    `overrides` (`location_name`, `override`) replaces addresses. Districts lose their names, districts
    without an address are left out, repeated rows are dropped.
    """
    set_ = names.join(overrides, "location_name", "left")
    set_ = set_.withColumn("uri", F.coalesce("override", "uri")).drop("override")
    district = F.col("level") == 2
    kept = set_.where(~(district & F.coalesce(F.col("uri") == "", F.lit(True))))
    blank = {
        c: F.when(~district, F.col(c)) for c in ("location_name", "location_name_ara")
    }
    columns = ["location_name", "uri", "location_name_ara", "country", "level"]
    return kept.withColumns(blank).select(*columns).distinct()


def page_names(pages: DataFrame, lang: str = "ar") -> DataFrame:
    """Heading, bold texts of the first two paragraphs, and heading of the other-language page.

    `pages` holds stored pages (`url`, `html`); the other page is looked up among them by its address.
    """
    html = F.col("html")
    heading = plain_text(F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1))
    parts = F.slice(F.split(html, r"<p(?:\s[^>]*)?>", -1), 2, 2)
    paragraphs = F.transform(parts, lambda p: F.substring_index(p, "</p>", 1))
    bold = F.flatten(
        F.transform(
            paragraphs,
            lambda p: F.regexp_extract_all(p, F.lit(r"(?s)<(?:b|strong)>(.*?)</(?:b|strong)>"), F.lit(1)),
        )
    )
    link = F.regexp_extract(html, rf'<a\s[^>]*hreflang="{lang}"[^>]*>', 0)
    href = F.regexp_extract(link, r'href="([^"]*)"', 1)
    full = F.when(href.startswith("http"), href).when(href != "", F.concat(F.lit("https:"), href))
    titled = pages.select(
        "url",
        heading.alias("title"),
        F.transform(bold, plain_text).alias("bold_names"),
        full.alias("other_url"),
    )
    # An address stored several times would repeat rows: one title per address is kept.
    others = titled.groupBy(F.col("url").alias("other_url")).agg(F.min("title").alias("title_other"))
    return titled.join(others, "other_url", "left")


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: tags removed, the common character references resolved."""
    text = F.regexp_replace(markup, r"<[^>]*>", "")
    for code, sign in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}.items():
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text
