"""Bronze text records to typed, deduplicated silver tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import month_from_text, month_of_period
from quayside.functions.numbers import money
from quayside.functions.text import char, varchar
from quayside.operators.cleansing import latest_per_key, positive, resolve_name, shares_unknown, sum_unknown
from quayside.operators.incremental import newer_than
from quayside.sources.tables import stored

# Defaults for missing parts, and the region of states outside the list.
NO_MEMBER, NO_HEADING, NO_REGION = "N/A", "0000", "Não se aplica"
TRADE_KEY = ("noMunMinsgUf", "year", "monthNumber", "country", "headingCode")
UNKNOWN = {"city_id": NO_MEMBER, "trade_country_id": NO_MEMBER}
RECORD = ("noMunMinsgUf", "country")


@dataclass(frozen=True)
class Widths:
    """Characters kept of texts and ids; longer ones are cut, which :func:`quality.cut_values` finds beforehand."""

    city: int = 7
    country: int = 10
    fact_city: int = 50
    fact_country: int = 4
    heading: int = 4
    name: int = 100
    place: int = 50


WIDTHS = Widths()


def run_time(run_at: datetime | None):
    return F.lit(run_at).cast("timestamp_ntz") if run_at else F.current_timestamp().cast("timestamp_ntz")


def silver_trades(
    bronze: DataFrame,
    cities: DataFrame,
    countries: DataFrame,
    flag: str,
    run_at: datetime | None = None,
    target: DataFrame | None = None,
    widths: Widths = WIDTHS,
    since: date | None = None,
    unknown: str = "strict",
) -> DataFrame:
    """Trades of one direction with resolved city and country.

    The newest copy of each record is chosen first and tested after, so an invalid newest copy hides
    an older valid one. Tests run before the joins: only rows that stay are matched to names. With a
    ``target``, or its mark in ``since``, only months from its latest on are kept. With ``unknown="sum"``
    records that differ but meet on the unknown member are summed; else they stay, and break the key.
    """
    placed = resolved_trades(bronze, cities, countries, flag, run_at, target, widths, since)
    if unknown == "sum":
        # both kinds of rows are read from one table, where only those with an unknown member need their names
        placed = placed.withColumns({c: F.when(shares_unknown(UNKNOWN), F.col(c)) for c in RECORD})
        placed = sum_unknown(stored(placed, "placed"), FACT_KEY, RECORD, UNKNOWN, ("fob_value", "net_weight"))
    return placed.select(*SILVER_COLUMNS)


def unknown_report(placed: DataFrame) -> DataFrame:
    """Of :func:`resolved_trades`: keys on which different records meet because of the unknown member, and the records."""
    met = sum_unknown(placed, FACT_KEY, RECORD, UNKNOWN, ("fob_value", "net_weight")).filter("records > 1")
    sums = [F.sum(c).cast("decimal(38,2)").alias(c) for c in ("fob_value", "net_weight")]
    return met.groupBy("trade_flag").agg(F.count("*").alias("keys"), F.sum("records").alias("records"), *sums)


FACT_KEY = ("trade_date", "city_id", "trade_country_id", "product_category_id", "trade_flag")
SILVER_COLUMNS = (*FACT_KEY[:4], "fob_value", "net_weight", "trade_flag", "ingested_at", "loaded_at", "processed_at")


def resolved_trades(
    bronze: DataFrame,
    cities: DataFrame,
    countries: DataFrame,
    flag: str,
    run_at: datetime | None = None,
    target: DataFrame | None = None,
    widths: Widths = WIDTHS,
    since: date | None = None,
) -> DataFrame:
    """Silver trades with the names they came with, one row per record."""
    newest = latest_per_key(bronze, TRADE_KEY, "loaded_at", ("ingested_at", "metricFOB", "metricKG"))
    typed = newest.select(
        month_from_text(F.col("year"), F.col("monthNumber"), "1900").alias("trade_date"),
        "noMunMinsgUf",
        "country",
        char(F.coalesce("headingCode", F.lit(NO_HEADING)), widths.heading).alias("product_category_id"),
        money(F.coalesce("metricFOB", F.lit("0"))).alias("fob_value"),
        money(F.coalesce("metricKG", F.lit("0"))).alias("net_weight"),
        F.lit(flag).alias("trade_flag"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )
    valid = typed.filter(positive(F.col("fob_value")) & positive(F.col("net_weight")))
    if target is not None:
        valid = newer_than(valid, target, "trade_date", or_equal=True)
    if since is not None:
        valid = valid.filter(F.col("trade_date") >= F.lit(since))
    placed = resolve_name(valid, "noMunMinsgUf", cities, "text", "id", "_city")
    placed = resolve_name(placed, "country", countries, "text", "id", "_country")
    return placed.select(
        "trade_date",
        varchar(F.coalesce("_city", F.lit(NO_MEMBER)), widths.fact_city).alias("city_id"),
        varchar(F.coalesce("_country", F.lit(NO_MEMBER)), widths.fact_country).alias("trade_country_id"),
        *RECORD,
        "product_category_id",
        "fob_value",
        "net_weight",
        "trade_flag",
        "ingested_at",
        "loaded_at",
        run_time(run_at).alias("processed_at"),
    )


def silver_cities(
    cities: DataFrame,
    states: DataFrame,
    regions: DataFrame,
    run_at: datetime | None = None,
    target: DataFrame | None = None,
    widths: Widths = WIDTHS,
) -> DataFrame:
    """Cities with the state and region read off the name's last two letters."""
    rows = cities if target is None else newer_than(cities, target, "loaded_at")
    newest = latest_per_key(rows, ["id"], "loaded_at", ("ingested_at", "text"))
    placed = (
        newest.withColumn("uf", F.right(F.trim("text"), F.lit(2)))
        .join(states.select("uf", F.col("text").alias("state_name")), "uf", "left")
        .join(regions.select("uf", "region"), "uf", "left")
    )
    return placed.select(
        char(F.col("id"), widths.city).alias("city_id"),
        varchar(F.col("noMunMin"), widths.name).alias("city_name"),
        varchar(F.col("state_name"), widths.place).alias("state_name"),
        char(F.col("uf"), 2).alias("uf"),
        varchar(F.col("text"), widths.name).alias("city_uf"),
        varchar(F.coalesce("region", F.lit(NO_REGION)), widths.place).alias("region"),
        "ingested_at",
        "loaded_at",
        run_time(run_at).alias("processed_at"),
    )


def silver_countries(countries: DataFrame, run_at: datetime | None = None, target: DataFrame | None = None, widths: Widths = WIDTHS) -> DataFrame:
    rows = countries if target is None else newer_than(countries, target, "loaded_at")
    newest = latest_per_key(rows, ["id"], "loaded_at", ("ingested_at", "text"))
    return newest.select(
        varchar(F.col("id"), widths.country).alias("country_id"),
        varchar(F.col("text"), widths.name).alias("country_name"),
        "ingested_at",
        "loaded_at",
        run_time(run_at).alias("processed_at"),
    )


def silver_index(index: DataFrame, run_at: datetime | None = None, target: DataFrame | None = None) -> DataFrame:
    """Monthly price index; the annual row (M13) and rows without a period are left out."""
    rows = index.filter(F.col("period") != "M13")
    if target is not None:
        rows = newer_than(rows, target, "loaded_at")
    newest = latest_per_key(rows, ["year", "period"], "loaded_at", ("ingested_at", "value"))
    month = month_of_period(F.col("period"))
    value = F.when(F.col("value") == "-", "0").otherwise(F.coalesce("value", F.lit("0")))
    typed = newest.select(
        month_from_text(F.col("year"), month, "1990").alias("cpi_date"),
        money(value).alias("cpi_value"),
        "ingested_at",
        "loaded_at",
        run_time(run_at).alias("processed_at"),
    )
    return typed.filter(positive(F.col("cpi_value")))
