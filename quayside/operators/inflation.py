"""Real values: nominal values times (latest index / index of the month)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_index(index: DataFrame) -> DataFrame:
    """One row, one column: the index of the latest month (not the largest index)."""
    return index.agg(F.max_by("cpi_value", "cpi_date").alias("latest"))


def index_ratio(index: DataFrame) -> DataFrame:
    """(cpi_date, index_ratio); the ratio is rounded to cents before any value is multiplied by it.

    The latest value is one scalar subquery, no one-row join. Months are grouped, so there is one row
    per month, however large the source of the index is.
    """
    latest = latest_index(index).scalar()
    exact = (latest / F.col("cpi_value")).cast("decimal(20,2)")
    return index.groupBy("cpi_date").agg(F.max(exact).alias("index_ratio"))


def deflate(trades: DataFrame, index: DataFrame, column: str = "fob_value", out: str = "fob_value_real") -> DataFrame:
    """Add the real value; months without an index get NULL and stay.

    No hint: the planner broadcasts the months by their measured size, else the adaptive join splits
    a month with many trades.
    """
    ratios = index_ratio(index).withColumnRenamed("cpi_date", "trade_date")
    joined = trades.join(ratios, "trade_date", "left")
    return joined.withColumn(out, (F.col(column) * F.col("index_ratio")).cast("decimal(38,4)")).drop("index_ratio")
