"""Month arithmetic and the text-to-date rules of the landed records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d.cast("date"), "month")


def next_month(d: Column) -> Column:
    """First day of the following month."""
    return F.add_months(F.trunc(d, "month"), 1)


def year_end(d: Column) -> Column:
    return F.make_date(F.year(d), F.lit(12), F.lit(31))


def period_code(d: Column) -> Column:
    """``yyyyMM``, as used in landing file names."""
    return F.date_format(d, "yyyyMM")


def period_name(d: Column) -> Column:
    """``yyyy-MM``, as used in source requests."""
    return F.date_format(d, "yyyy-MM")


def parse_period_code(c: Column) -> Column:
    return F.to_date(c, "yyyyMM")


def month_from_text(year: Column, month: Column, default_year: str) -> Column:
    """First day of a month given as text parts; missing parts take defaults, bad ones give NULL."""
    text = F.concat_ws("/", F.coalesce(year, F.lit(default_year)), F.coalesce(month, F.lit("01")), F.lit("1"))
    return F.try_to_date(text, "yyyy/M/d")


def month_of_period(period: Column) -> Column:
    """``M3`` -> ``03``."""
    return F.lpad(F.regexp_replace(period, "[^0-9]", ""), 2, "0")
