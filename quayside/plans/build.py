"""One monthly run: silver, its tests, gold, its tests, each layer written as Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from quayside.operators import quality
from quayside.plans import gold, silver
from quayside.plans.star import Star
from quayside.sources import partitioned, tables


@dataclass(frozen=True)
class Bronze:
    exports: DataFrame
    imports: DataFrame
    cities: DataFrame
    states: DataFrame
    regions: DataFrame
    countries: DataFrame
    index: DataFrame
    products: DataFrame
    manifests: Mapping[str, DataFrame] = field(default_factory=dict)


def _current(spark: SparkSession, path: str, full_refresh: bool) -> DataFrame | None:
    return None if full_refresh else tables.read_current(spark, path)


def build_silver(
    spark: SparkSession, root: str, bronze: Bronze, run_at: datetime, full_refresh: bool = False, unknown: str = "strict", widths: silver.Widths = silver.WIDTHS
) -> None:
    """Facts are merged by month partition, members and index as versions.

    The month from which trades are taken again is read off the partition names, not off the rows. Manifest rows of a
    side's files are committed with its table.
    """
    for name, rows, flag in (("exports", bronze.exports, "exp"), ("imports", bronze.imports, "imp")):
        path = f"{root}/silver/{name}"
        since = None if full_refresh else partitioned.mark(spark, path)
        new = silver.silver_trades(rows, bronze.cities, bronze.countries, flag, run_at, widths=widths, since=since, unknown=unknown)
        partitioned.upsert(spark, path, new, silver.FACT_KEY, "trade_date", replace=full_refresh, manifest=bronze.manifests.get(name))
    for name, key, make in (
        ("cities", "city_id", lambda t: silver.silver_cities(bronze.cities, bronze.states, bronze.regions, run_at, t, widths)),
        ("countries", "country_id", lambda t: silver.silver_countries(bronze.countries, run_at, t, widths)),
        ("cpi", "cpi_date", lambda t: silver.silver_index(bronze.index, run_at, t)),
    ):
        path = f"{root}/silver/{name}"
        old = _current(spark, path, full_refresh)
        if old is None:
            tables.write_version(spark, path, make(None))
        else:
            tables.upsert_version(spark, path, make(old), [key])


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    sides = {n: partitioned.read(spark, f"{root}/silver/{n}") for n in ("exports", "imports")}
    return sides | {n: tables.read_current(spark, f"{root}/silver/{n}") for n in ("cities", "countries", "cpi")}


def build_gold(
    spark: SparkSession, root: str, bronze: Bronze, run_at: datetime, full_refresh: bool = False, unknown_member: bool = False, widths: silver.Widths = silver.WIDTHS
) -> None:
    """The fact and its dimensions; ``unknown_member`` gives unmatched names a member to point to.

    Silver lies by month already, and the fact's rows keep that order: they are written as they are read.
    """
    s = read_silver(spark, root)
    path = f"{root}/gold/fact_trades"
    since = None if full_refresh else partitioned.mark(spark, path)
    fact = gold.fact_trades(s["imports"], s["exports"], s["cpi"], run_at, since=since)
    partitioned.upsert(spark, path, fact, gold.FACT_KEY, "trade_date", replace=full_refresh, gathered=True)
    for name, key, rows in (
        ("dim_cities", "city_id", gold.dim_cities(s["cities"], run_at)),
        ("dim_countries", "country_id", gold.dim_countries(s["countries"], run_at)),
    ):
        where = f"{root}/gold/{name}"
        rows = quality.with_unknown_member(rows, key, created_at=silver.run_time(run_at)) if unknown_member else rows
        if full_refresh:
            tables.write_version(spark, where, rows)
        else:
            tables.insert_new_version(spark, where, rows, key)
    tables.write_snapshot(gold.dim_product_categories(bronze.products, widths), f"{root}/gold/dim_product_categories")


def read_gold(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        partitioned.read(spark, f"{root}/gold/fact_trades"),
        tables.read_current(spark, f"{root}/gold/dim_cities"),
        tables.read_current(spark, f"{root}/gold/dim_countries"),
        spark.read.parquet(f"{root}/gold/dim_product_categories"),
    )


def run(
    spark: SparkSession,
    root: str,
    bronze: Bronze,
    run_at: datetime,
    full_refresh: bool = False,
    unknown_member: bool = False,
    unknown: str = "strict",
    widths: silver.Widths = silver.WIDTHS,
) -> Star:
    """Build both layers; a failing test stops the run before the next layer. Returns the star.

    ``unknown="sum"`` sums records that meet on the unknown member, ``unknown_member`` gives that member a row in its
    dimension; without both, records without a known name stop the run.
    """
    build_silver(spark, root, bronze, run_at, full_refresh, unknown, widths)
    s = read_silver(spark, root)
    quality.gate(gold.silver_tests(s["exports"], s["imports"], s["cities"], s["countries"], s["cpi"]))
    build_gold(spark, root, bronze, run_at, full_refresh, unknown_member, widths)
    star = read_gold(spark, root)
    quality.gate(gold.star_tests(*star))
    return Star(*star)
