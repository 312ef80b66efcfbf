"""Column functions on small inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.functions import dates, numbers, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def pair(spark, a, b, f, kind="decimal(20,2)"):
    a, b = (None if v is None else Decimal(v) for v in (a, b))
    return spark.createDataFrame([(a, b)], f"a {kind}, b {kind}").select(f(F.col("a"), F.col("b"))).first()[0]


@pytest.mark.parametrize("given, expected", [("São João d'El-Rei - MG", "saojoaodelreimg"), ("Œuvre ß", "oeuvress"), (None, None), ("123", "")])
def test_normalize_name(spark, given, expected):
    assert one(spark, given, text.normalize_name) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("1000", "1000"), ("1000.01", "1.00 K"), ("2500000", "2.50 Mi"), ("3000000000", "3.00 Bi"), ("-2500000", "-2500000"), (None, None)],
)
def test_magnitude(spark, given, expected):
    value = None if given is None else Decimal(given)
    assert one(spark, value, text.magnitude, "decimal(20,2)") == expected


def test_magnitude_by_size_alone(spark):
    assert one(spark, Decimal("-2500000"), lambda c: text.magnitude(c, absolute=True), "decimal(20,2)") == "-2.50 Mi"


@pytest.mark.parametrize("given, expected", [(999.0, "999 Kg"), (1000.0, "1.00 Ton"), (1234500.0, "1,234.50 Ton")])
def test_weight(spark, given, expected):
    assert one(spark, given, text.weight, "double") == expected


@pytest.mark.parametrize("given, expected", [(0.26, "+0.3 p.p."), (-0.26, "-0.3 p.p."), (0.0, "0.0 p.p."), (None, None)])
def test_signed_points(spark, given, expected):
    assert one(spark, given, text.signed_points, "double") == expected


def test_percent_forms(spark):
    assert one(spark, 0.1234, text.percent, "double") == "12.3%"
    assert one(spark, 0.05, text.whole_percent, "double") == "05%"
    assert one(spark, 3.4, text.times, "double") == "3x"


def test_cut_text(spark):
    assert one(spark, "abcdef", lambda c: text.varchar(c, 4)) == "abcd"
    assert one(spark, "ab  ", lambda c: text.char(c, 3)) == "ab"


def test_fill_leaves_missing_parts_out(spark):
    assert one(spark, None, lambda c: text.fill("a {x} b", x=c)) == "a  b"


@pytest.mark.parametrize("year, month, expected", [("2024", "3", dt.date(2024, 3, 1)), ("2024", "03", dt.date(2024, 3, 1)), (None, None, dt.date(1900, 1, 1)), ("2024", "13", None)])
def test_month_from_text(spark, year, month, expected):
    df = spark.createDataFrame([(year, month)], "y string, m string")
    assert df.select(dates.month_from_text(F.col("y"), F.col("m"), "1900")).first()[0] == expected


def test_period_parts(spark):
    assert one(spark, "M3", dates.month_of_period) == "03"
    assert one(spark, dt.date(2024, 12, 5), dates.next_month, "date") == dt.date(2025, 1, 1)
    assert one(spark, dt.date(2024, 2, 1), text.month_label, "date") == "Fev/24"
    assert one(spark, dt.date(2024, 2, 1), text.month_year_label, "date") == "fev/2024"


@pytest.mark.parametrize("a, b, added, subtracted", [(None, "3", "3", "-3"), ("5", None, "5", "5"), (None, None, None, None), ("5", "3", "8", "2")])
def test_blank_arithmetic(spark, a, b, added, subtracted):
    expect = lambda v: None if v is None else Decimal(v)
    assert pair(spark, a, b, numbers.blank_add) == expect(added)
    assert pair(spark, a, b, numbers.blank_subtract) == expect(subtracted)


def test_ratio_of_nothing(spark):
    assert pair(spark, "5", "0", numbers.ratio) is None
    assert pair(spark, "5", None, numbers.ratio) is None
    assert pair(spark, "5", "2", numbers.ratio) == 2.5
