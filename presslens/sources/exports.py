"""Text exports of a news database: tables in an envelope, and headline lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.schemas import EXPORT_LINE

FOOTER_LINES = 14
# Of the lines that are not blank: a title, the line with the result count, a line without use, the
# column names, then the data.
COUNT_LINE, FIRST_DATA_LINE = 2, 5
# A footer line has its label and its value in the columns of these names.
LABEL_COLUMN, VALUE_COLUMN = "Source", "Document Count"


def _digits(text: Column) -> Column:
    found = F.nullif(F.regexp_extract(text, r"\d+", 0), F.lit(""))
    return found.cast("long")


def parse_export(files: DataFrame, text: str = "text", schema: str = EXPORT_LINE) -> DataFrame:
    """One row per data line of every export, with what the header and the footer say.

    `files` has one whole file per row. The footer gives language (three letters), region, dates, text
    and number of results; `counts_agree` tells whether header and footer name the same number.
    """
    keep = [c for c in files.columns if c != text]
    lines = F.filter(F.split(F.replace(F.col(text), F.lit("\r"), F.lit("")), "\n", -1), lambda x: F.trim(x) != "")
    cut = files.select(*keep, lines.alias("_lines"))
    n = F.size("_lines")
    n_data = F.greatest(n - FOOTER_LINES - FIRST_DATA_LINE + 1, F.lit(0))
    footer_start = F.greatest(n - FOOTER_LINES + 1, F.lit(1))
    # Every line has the columns that the column line names.
    width = len(T.StructType.fromDDL(schema))
    texts = F.lit(", ".join(f"c{i} STRING" for i in range(width)))

    def fields(line):
        row = F.from_csv(line, texts)
        return F.array(*[row[f"c{i}"] for i in range(width)])

    named = fields(F.try_element_at("_lines", F.lit(FIRST_DATA_LINE - 1)))
    cut = cut.withColumns(
        {
            "_data": F.slice("_lines", F.lit(FIRST_DATA_LINE), n_data),
            "_footer": F.transform(F.slice("_lines", footer_start, F.lit(FOOTER_LINES)), fields),
            "_label": F.array_position(named, LABEL_COLUMN).cast("int"),
            "_value": F.array_position(named, VALUE_COLUMN).cast("int"),
        }
    )

    def footer(name):
        line = F.filter("_footer", lambda x: F.get(x, F.col("_label") - 1) == name)
        return F.get(F.get(line, F.lit(0)), F.col("_value") - 1)

    dates = F.replace(footer("Date"), F.lit("/"), F.lit(""))
    header_results = _digits(F.try_element_at("_lines", F.lit(COUNT_LINE)))
    footer_results = _digits(F.replace(footer("Results Found"), F.lit(","), F.lit("")))
    described = cut.select(
        *keep,
        F.posexplode("_data").alias("position", "_line"),
        F.substring(F.lower(footer("Language")), 1, 3).alias("lang"),
        F.replace(F.lower(footer("Region")), F.lit(" "), F.lit("_")).alias("region"),
        F.split_part(dates, F.lit(" to "), F.lit(1)).alias("from_date"),
        F.split_part(dates, F.lit(" to "), F.lit(2)).alias("to_date"),
        F.nullif(footer("Text"), F.lit("")).alias("query_text"),
        footer_results.alias("results"),
        header_results.eqNullSafe(footer_results).alias("counts_agree"),
    )
    values = F.from_csv("_line", F.lit(schema))
    return described.select("*", values.alias("_row")).select(
        *keep,
        "position",
        "_row.*",
        "lang",
        "region",
        "from_date",
        "to_date",
        "query_text",
        "results",
        "counts_agree",
    )


def count_mismatches(parsed: DataFrame) -> DataFrame:
    """Data rows of exports whose header and footer counts differ; must be empty."""
    return parsed.where(~F.col("counts_agree"))


def export_file_name(region: Column, text: Column, start: Column, end: Column, lang: Column, n: Column):
    """`<region>[_<text>]_<from>_<to>_<lang>_<n>`."""
    return F.concat_ws("_", region, text, start, end, lang, n.cast("string"))


def extract_headlines(
    files: DataFrame,
    headline_marker: str,
    meta_marker: str,
    cut_at: str = '("',
    text: str = "text",
) -> DataFrame:
    """Headlines of text exports with the source and date of the meta line of the same rank.

    A headline is a line with the first marker, up to `cut_at`. A meta line has the second marker; with
    four or five comma-separated parts the first is the source and the third the date, else both are
    null.
    """
    keep = [c for c in files.columns if c != text]
    lines = F.split(text, "\n", -1)

    def marked(marker):
        return F.filter(lines, lambda x: x.contains(marker))

    heads = F.transform(
        marked(headline_marker), lambda x: F.trim(F.substring_index(x, cut_at, 1))
    )
    paired = files.select(
        *keep,
        F.posexplode(F.arrays_zip(heads.alias("headline"), marked(meta_marker).alias("meta"))).alias(
            "position", "_pair"
        ),
    ).where("_pair.headline IS NOT NULL")
    parts = F.split("_pair.meta", ",", -1)
    complete = F.size(parts).isin(4, 5)
    return paired.select(
        *keep,
        "position",
        F.when(complete, F.try_element_at(parts, F.lit(1))).alias("source"),
        F.when(complete, F.try_element_at(parts, F.lit(3))).alias("date"),
        F.col("_pair.headline").alias("headline"),
    )
