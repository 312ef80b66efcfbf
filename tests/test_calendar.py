"""The calendar against Python's own, and its parameters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.operators import calendar as C


@pytest.fixture(scope="module")
def bounds(spark):
    return spark.createDataFrame([(dt.date(2006, 1, 1), dt.date(2026, 5, 20), dt.date(2026, 12, 31))], "S date, T date, E date")


@pytest.fixture(scope="module")
def days(bounds):
    wanted = "Date DateIndex WeekOfYearNumberISO YearISO WeekIndexISO WeekOfMonthNumber FiscalYearsToToday CurrentDate ClosingMonthNumber Holiday BusinessDayNumber DayOfWeekName MonthYearName".split()
    return {r.Date: r for r in C.calendar(bounds).select(*wanted).collect()}


def test_every_day_once(days):
    assert len(days) == (dt.date(2026, 12, 31) - dt.date(2006, 1, 1)).days + 1


def test_iso_weeks_agree_with_python(days):
    for d, r in days.items():
        assert (r.YearISO, r.WeekOfYearNumberISO) == d.isocalendar()[:2]


def test_samples(days):
    assert (days[dt.date(2021, 1, 3)].WeekOfYearNumberISO, days[dt.date(2021, 1, 3)].YearISO) == (53, 2020)
    assert (days[dt.date(2026, 2, 1)].WeekOfMonthNumber, days[dt.date(2026, 2, 2)].WeekOfMonthNumber) == (1, 2)
    assert days[dt.date(2006, 1, 1)].WeekIndexISO == 1
    assert days[dt.date(2026, 5, 20)].CurrentDate == "Atual" and days[dt.date(2026, 5, 21)].CurrentDate == "21/05/2026"
    assert (days[dt.date(2024, 1, 16)].ClosingMonthNumber, days[dt.date(2024, 1, 17)].ClosingMonthNumber) == (1, 2)
    assert days[dt.date(2024, 3, 31)].Holiday == "Páscoa" and days[dt.date(2024, 3, 29)].BusinessDayNumber == 0
    assert (days[dt.date(2024, 3, 2)].DayOfWeekName, days[dt.date(2024, 3, 2)].MonthYearName) == ("Sábado", "Mar/24")


def test_published_fiscal_rule_is_one_year_ahead(bounds, days):
    assert days[dt.date(2026, 5, 20)].FiscalYearsToToday == -1
    fixed = C.calendar(bounds, fixed=True).filter("Date = '2026-05-20'").first()
    assert (fixed.FiscalYearsToToday, fixed.CurrentFiscalYear, fixed.FiscalMonthsToToday, fixed.FiscalQuartersToToday) == (0, "Atual", 0, 0)


def easter_by_algorithm(y):
    a, b, c = y % 19, y // 100, y % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    n = h + k - 7 * ((a + 11 * h + 22 * k) // 451) + 114
    return dt.date(y, n // 31, n % 31 + 1)


def test_easter(spark):
    got = {r.y: r.d for r in spark.range(2006, 2041).select(F.col("id").alias("y"), C.easter(F.col("id").cast("int")).alias("d")).collect()}
    assert got == {y: easter_by_algorithm(y) for y in got}


def test_holidays_on_one_day_are_joined(spark):
    # Easter 2011 fell on 24 April, Good Friday on 22 April; Tiradentes is 21 April
    b = spark.createDataFrame([(dt.date(2000, 1, 1), dt.date(2014, 12, 31), dt.date(2014, 12, 31))], "S date, T date, E date")
    got = {r.date: r.holiday for r in C.holidays(b).collect()}
    assert got[dt.date(2000, 4, 21)] == "Tiradentes/Sexta-Feira Santa"
    assert len([d for d in got if d.year == 2011]) == 16


def test_languages_and_names(bounds, spark):
    en = C.calendar(bounds, language="en-US").filter("Date = '2024-07-04'").first()
    assert (en.Holiday, en.DayOfWeekName, en.QuarterName, en.SeasonNorthName) == ("Independence Day", "Thursday", "Q3", "Summer")
    pt = C.renamed(C.calendar(bounds))
    assert len(pt.columns) == 114 and pt.columns[0] == "Data" and pt.columns[-1] == "DiaDoTrimestreFiscal"
    assert "Jahr" in C.renamed(C.calendar(bounds), {"Year": "Jahr"}).columns
    assert dict(tuple(r) for r in C.labels(spark, "es-ES").collect())["autumn"] == "Otoño"


def test_parameters(bounds):
    sunday = C.calendar(bounds, week_start=6, fiscal_end_month=12).filter("Date = '2024-03-03'").first()
    assert (sunday.DayOfWeekNumber, sunday.FiscalYearStartNumber, sunday.FiscalYearStart) == (0, 2023, dt.date(2023, 1, 1))
