"""Silver tables to the star: fact, dimensions and their data tests."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import char, varchar
from quayside.operators import quality
from quayside.operators.incremental import newer_than
from quayside.operators.inflation import deflate, latest_index
from quayside.plans.silver import FACT_KEY, WIDTHS, Widths, run_time

FACT_COLUMNS = (*FACT_KEY[:4], "fob_value", "fob_value_real", "net_weight", "trade_flag", "created_at")


def fact_trades(
    imports: DataFrame,
    exports: DataFrame,
    index: DataFrame,
    run_at: datetime | None = None,
    target: DataFrame | None = None,
    since: date | None = None,
) -> DataFrame:
    """Both directions with real values; nothing at all when there is no index.

    With a ``target``, or its mark in ``since``, only months from its latest on are built, and real values of older rows stay
    as they were written. Without one, everything is recomputed with the latest index.
    """
    columns = [*FACT_KEY[:4], "fob_value", "net_weight", "trade_flag"]
    sides = [s.select(*columns) for s in (imports, exports)]
    if target is not None:
        sides = [newer_than(s, target, "trade_date", or_equal=True) for s in sides]
    if since is not None:
        sides = [s.filter(F.col("trade_date") >= F.lit(since)) for s in sides]
    united = sides[0].unionByName(sides[1]).filter(latest_index(index).scalar().isNotNull())
    return deflate(united, index).withColumn("created_at", run_time(run_at)).select(*FACT_COLUMNS)


def dim_cities(silver: DataFrame, run_at: datetime | None = None) -> DataFrame:
    columns = ("city_id", "city_name", "state_name", "uf", "city_uf", "region")
    return silver.select(*columns, run_time(run_at).alias("created_at"))


def dim_countries(silver: DataFrame, run_at: datetime | None = None) -> DataFrame:
    return silver.select("country_id", "country_name", run_time(run_at).alias("created_at"))


def dim_product_categories(seed: DataFrame, widths: Widths = WIDTHS) -> DataFrame:
    return seed.select(
        char(F.col("product_category_id"), widths.heading).alias("product_category_id"),
        varchar(F.col("product_category_name"), widths.name).alias("product_category_name"),
        F.col("product_category_description").cast("string").alias("product_category_description"),
    )


def star_tests(fact: DataFrame, cities: DataFrame, countries: DataFrame, products: DataFrame) -> DataFrame:
    """Data tests of the gold layer; the fact is read once for all of its tests."""
    q = quality
    parents = {"city_id": (cities, "city_id"), "trade_country_id": (countries, "country_id"), "product_category_id": (products, "product_category_id")}
    return q.report(
        q.suite(fact, "fact_trades", [c for c in FACT_COLUMNS if c != "fob_value_real"], FACT_KEY, parents),
        q.suite(cities, "dim_cities", cities.columns, ["city_id"]),
        q.suite(countries, "dim_countries", countries.columns, ["country_id"]),
        q.suite(products, "dim_product_categories", products.columns, ["product_category_id"]),
    )


def seed_tests(products: DataFrame, regions: DataFrame) -> DataFrame:
    """Data tests of the seed files."""
    q = quality
    return q.report(
        q.not_null(products, "seed_product_categories", products.columns),
        *[q.unique(products, "seed_product_categories", [c]) for c in products.columns],
        q.not_null(regions, "seed_state_regions", ["uf", "region"]),
        q.unique(regions, "seed_state_regions", ["uf"]),
    )


def silver_tests(exports: DataFrame, imports: DataFrame, cities: DataFrame, countries: DataFrame, index: DataFrame) -> DataFrame:
    """Data tests of the silver layer."""
    q = quality
    return q.report(
        q.suite(exports, "silver_exports", exports.columns, FACT_KEY),
        q.suite(imports, "silver_imports", imports.columns, FACT_KEY),
        q.suite(cities, "silver_cities", cities.columns, ["city_id"]),
        q.suite(countries, "silver_countries", countries.columns, ["country_id"]),
        q.suite(index, "silver_cpi", index.columns, ["cpi_date"]),
    )
