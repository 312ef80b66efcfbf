"""Landed response pages (JSON text) to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCEEDED = "REQUEST_SUCCEEDED"  # fixed value: status of a good index response


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed page, its text in ``value``."""
    return spark.read.text(path, wholetext=True)


def trade_records(page: Column, record: str) -> Column:
    """The record array of ``{data: {list: [...]}}`` or ``{data: [...]}``; ``record`` is a DDL struct body."""
    wrapped = F.from_json(page, f"data struct<list: array<struct<{record}>>>").getField("data").getField("list")
    bare = F.from_json(page, f"data array<struct<{record}>>").getField("data")
    return F.coalesce(wrapped, bare)


def trade_fault(page: Column, record: str) -> Column:
    """Why a trade page gives no records; null for a good one, also for one with an empty list."""
    empty = page.isNull() | (F.trim(page) == "")
    return F.when(empty, "empty").when(F.get_json_object(page, "$").isNull(), "not JSON").when(trade_records(page, record).isNull(), "no record list")


def index_fault(page: Column, record: str) -> Column:
    """The same for an index page: refused ones have their status as the reason."""
    body = F.from_json(page, f"status string, Results struct<series: array<struct<data: array<struct<{record}>>>>>")
    empty = page.isNull() | (F.trim(page) == "")
    wrong = F.when(empty, "empty").when(F.get_json_object(page, "$").isNull(), "not JSON")
    wrong = wrong.when(~body["status"].eqNullSafe(SUCCEEDED), F.concat(F.lit("status "), F.coalesce(body["status"], F.lit("missing"))))
    return wrong.when(F.get(body["Results"]["series"], F.lit(0))["data"].isNull(), "no record list")


def judged(pages: DataFrame, fault: Column) -> DataFrame:
    """Pages with their ``reason``: null for those to flatten, else to be kept apart with the path they came from.

    Write this once and read it twice, for records and for the rejected: accepted and rejected pages make up all.
    """
    return pages.withColumn("reason", fault)


def unreadable(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values that a cast would turn into nothing: the rows' columns, and column_name, value and type of the first one."""
    tests = []
    for name, kind in types.items():
        bad = F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"), F.lit(kind).alias("type"))
        tests.append(F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), bad))
    return rows.withColumn("_bad", F.coalesce(*tests)).filter(F.col("_bad").isNotNull()).select(*rows.columns, "_bad.*")


def flatten_trade(pages: DataFrame, record: str, column: str = "value") -> DataFrame:
    return pages.select(F.explode(trade_records(F.col(column), record)).alias("r")).select("r.*")


def flatten_index(pages: DataFrame, record: str, column: str = "value") -> DataFrame:
    """Records of the first series; pages with another status give none."""
    body = F.from_json(F.col(column), f"status string, Results struct<series: array<struct<data: array<struct<{record}>>>>>")
    good = pages.select(body.alias("b")).filter(F.col("b.status") == SUCCEEDED)
    return good.select(F.explode(F.get("b.Results.series", F.lit(0)).getField("data")).alias("r")).select("r.*")
