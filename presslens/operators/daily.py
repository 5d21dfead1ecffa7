"""Articles per day and location: the published table and its parts.

All counts are numbers of *articles*. Everything starts from the per-article id sets, so an article
counts once per location, category and keyword however often it matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.operators.mentions import category_of

ARTICLES = "count_articles"
ANY_KEYWORD = "kw"


def level_of(entity_id):
    """0 country, 1 province, 2 district: the number of underscores of the id."""
    return F.size(F.split(entity_id, "_", -1)) - 1


def country_of(entity_id):
    return F.split_part(entity_id, F.lit("_"), F.lit(1))


def measure_columns(keyword_ids: list[str]) -> list[str]:
    """Column order of the published table: sorted categories, each before its keywords, then kw."""
    columns = []
    for category in sorted({k.split("_")[0] for k in keyword_ids}):
        columns += [category, *(k for k in keyword_ids if k.split("_")[0] == category)]
    return [*columns, ANY_KEYWORD]


def _grouped(sets: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows that have all group keys; others belong to no row of a published table."""
    return sets.dropna(subset=list(by)) if by else sets


def location_counts(sets: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """Articles per group and location."""
    places = _grouped(sets, by).select(*by, F.explode("locations").alias("location"))
    return places.groupBy(*by, "location").agg(F.count("*").alias(ARTICLES))


def measure_counts(sets: DataFrame, measures, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """Articles per group, location and measure, where `measures` is an array column.

    The exploded rows are the (place, measure) cells of one article, bounded by the dictionaries; they
    are summed up map-side, so the shuffle carries at most one row per task and result cell.
    """
    places = _grouped(sets, by).select(*by, F.explode("locations").alias("location"), measures.alias("_measures"))
    cells = places.select(*by, "location", F.explode("_measures").alias("measure"))
    return cells.groupBy(*by, "location", "measure").agg(F.count("*").alias("n"))


def category_measures():
    """Categories of an article, plus `kw` when it has any keyword."""
    keywords = F.col("keywords")
    categories = F.array_distinct(F.transform(keywords, category_of))
    return F.when(F.size(keywords) > 0, F.array_append(categories, F.lit(ANY_KEYWORD)))


def category_counts(sets: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    return measure_counts(sets, category_measures(), by)


def keyword_counts(sets: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    return measure_counts(sets, F.col("keywords"), by)


def spine(
    articles: DataFrame,
    location_ids: list[str],
    by: tuple[str, ...] = ("date",),
    full_calendar: bool = False,
) -> DataFrame:
    """Every date that has an article, times every location of the dictionary.

    `full_calendar` adds the dates without any article between the first and the last.
    """
    days = articles.select(*by).where(F.col("date").isNotNull()).distinct()
    if full_calendar:
        others = [c for c in by if c != "date"]
        days = days.groupBy(*others).agg(F.min("date").alias("_from"), F.max("date").alias("_to"))
        days = days.select(*others, F.explode(F.sequence("_from", "_to")).alias("date"))
    return days.select(*by, F.explode(F.lit(location_ids)).alias("location"))


def zero_filled(
    articles: DataFrame,
    counted: DataFrame,
    location_ids: list[str],
    measures: list[str],
    by: tuple[str, ...] = ("date",),
    full_calendar: bool = False,
) -> DataFrame:
    """Spread long counts into one column per measure, with zeros for every cell of the spine.

    The spine is added as rows that count nothing, so one aggregation does the join, the zero fill and
    the pivot.
    """
    empty = spine(articles, location_ids, by, full_calendar).withColumns(
        {"measure": F.lit(ARTICLES), "n": F.lit(0).cast("long")}
    )
    wide = counted.unionByName(empty).groupBy(*by, "location").pivot("measure", measures).agg(F.sum("n").cast("long"))
    return wide.fillna(0, measures)


def daily_summary(
    articles: DataFrame,
    sets: DataFrame,
    keyword_ids: list[str],
    location_ids: list[str],
    languages: dict[str, str] | None = None,
    language: str = "English",
    full_calendar: bool = False,
) -> DataFrame:
    """The published table: articles per day, location and every category and keyword.

    With `languages` (code to printed name) all languages are counted in one pass over the articles,
    each with its own dates; otherwise every row carries the one given `language`.
    """
    by = ("date", "lang") if languages else ("date",)
    if languages:
        codes = list(languages)
        articles = articles.where(F.col("lang").isin(codes))
        sets = sets.where(F.col("lang").isin(codes))
    counted = measure_counts(sets, summary_measures(), by)
    return _summary(articles, counted, keyword_ids, location_ids, by, languages, language, full_calendar)


def summary_measures():
    """All that an article counts for: itself, its categories, any keyword, its keywords."""
    found = F.coalesce(category_measures(), F.array().cast("array<string>"))
    return F.concat(F.array(F.lit(ARTICLES)), found, F.col("keywords"))


def summary_cells(articles: DataFrame, sets: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """The long form of the published table: articles per group, location and measure, which add up over parts of the
    articles. A group with articles but without any count has a row without location and measure.
    """
    days = _grouped(articles, by).select(*by).distinct()
    empty = days.select(*by, *[F.lit(None).cast(t).alias(c) for c, t in (("location", "string"), ("measure", "string"), ("n", "long"))])
    return measure_counts(sets, summary_measures(), by).unionByName(empty)


def summary_of_cells(cells: DataFrame, keyword_ids: list[str], location_ids: list[str], languages: dict[str, str]) -> DataFrame:
    """The published table of cells (date, lang, location, measure, n), of as many parts as there are."""
    by = ("date", "lang")
    counted = cells.where("measure IS NOT NULL").groupBy(*by, "location", "measure").agg(F.sum("n").alias("n"))
    return _summary(cells, counted, keyword_ids, location_ids, by, languages, "", False)


def _summary(articles, counted, keyword_ids, location_ids, by, languages, language, full_calendar) -> DataFrame:
    printed = F.lit(language)
    if languages:
        printed = F.element_at(F.create_map(*[F.lit(x) for item in languages.items() for x in item]), F.col("lang"))
    columns = measure_columns(keyword_ids)
    wide = zero_filled(articles, counted, location_ids, [ARTICLES, *columns], by, full_calendar)
    return wide.select(
        "date",
        "location",
        ARTICLES,
        level_of(F.col("location")).alias("admin_level"),
        printed.alias("language"),
        *columns,
    )
