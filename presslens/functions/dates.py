"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_end(day: Column) -> Column:
    """Sunday that closes the week of a date."""
    return F.date_add(F.trunc(day, "week"), 6)


def year_end(day: Column) -> Column:
    return F.make_date(F.year(day), F.lit(12), F.lit(31))


def period_end(day: Column, period: str) -> Column:
    """Closing date of the week (W), month (M) or year (Y)."""
    return {"W": week_end, "M": F.last_day, "Y": year_end}[period](day)


def period_step(period: str) -> Column:
    return F.expr({"W": "interval 1 week", "M": "interval 1 month", "Y": "interval 1 year"}[period])


def iso_year(day: Column) -> Column:
    """Year of the ISO week: that of the week's Thursday."""
    return F.year(F.date_add(F.trunc(day, "week"), 3))


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0).cast("double")


def parse_http_date(text: Column) -> Column:
    """`Mon, 24 Jun 2024 07:00:00 GMT` to a timestamp, anything else to null.

    The weekday is dropped first because Spark's parser does not take its pattern letter.
    """
    bare = F.regexp_extract(text, r"^[A-Za-z]{3}, (\d{1,2} [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d) \w+$", 1)
    return F.try_to_timestamp(F.when(bare != "", bare), F.lit("d MMM yyyy HH:mm:ss"))
