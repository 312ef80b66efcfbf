"""Every query by name: each takes (spark, folder of tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import calendar, concentration, ranking, timeintel
from quayside.plans import measures as M
from quayside.plans import narrative
from quayside.plans import reports as R
from quayside.plans.cases import case_queries
from quayside.plans.pipeline import pipeline_queries
from quayside.plans.star import FilterContext, Star
from quayside.plans.table_star import read, table_star
from quayside.plans.upkeep import upkeep_queries

Query = Callable[[SparkSession, str], DataFrame]
CATEGORY = R.CATEGORY


def presented(df: DataFrame) -> DataFrame:
    """Doubles at six digits, so results compare across engines."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def on_star(f: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: presented(f(table_star(spark, sf_dir)))


def _shares(star: Star) -> DataFrame:
    groups = M.evaluate(star, ["exports", "imports"], ["country_name"])
    return R.export_import_shares(star, groups).select("country_name", "export_share", "import_share")


ALL_MEASURES = [*M.SUMS, *M.DERIVED]


def report_queries() -> dict[str, Query]:
    q: dict[str, Callable[[Star], DataFrame]] = {
        "monthly_trade_balance": lambda s: R.by_month(s, ["exports", "imports", "flow", "balance"]),
        "monthly_weights_and_prices": lambda s: R.by_month(
            s, ["export_weight", "import_weight", "export_price", "import_price", "coverage"]
        ),
        "monthly_real_balance": lambda s: R.by_month(s, ["balance", "exports_real", "imports_real", "balance_real"]),
        "all_measures_total": lambda s: M.evaluate(s, ALL_MEASURES, []),
        "measure_totals_cube": lambda s: R.totals(s, ["exports", "balance", "coverage"], ["year", "region"]),
        "country_share_of_total": _shares,
        "country_share_by_year": lambda s: M.share_over(s, "country_name", ["year"]),
        "concentration_by_year": R.concentration_by_year,
        "state_concentration_of_total": lambda s: concentration.hhi_of_total(s, "exports", "state_name", ["region"]),
        "state_import_concentration_of_total": lambda s: concentration.hhi_of_total(s, "imports", "state_name", ["region"]),
        "concentration_gauge": R.concentration_gauge,
        "exports_by_month_label": lambda s: R.by_month_label(s, ["exports"]),
        "year_over_year_by_month": lambda s: R.year_over_year(s, ["trade_date"]),
        "year_over_year_by_year": lambda s: R.year_over_year(s, ["year"]),
        "running_totals_by_year": lambda s: R.running_totals(s, ["year"]),
        "running_totals_by_country_month": lambda s: R.running_totals(s, ["country_name", "trade_date"]),
        "top_cities_by_exports": lambda s: R.top_members(s, "exports", "city_uf", 10),
        "top_cities_by_imports": lambda s: R.top_members(s, "imports", "city_uf", 10),
        "top_states_by_exports": lambda s: R.top_members(s, "exports", "state_name", 10),
        "top_countries_and_others": lambda s: R.top_shares_others(s, "exports", "country_name", 10),
        "top_states_squared_export_share": lambda s: R.top_squared_shares_others(s, "exports", "state_name", 10),
        "top_states_squared_import_share": lambda s: R.top_squared_shares_others(s, "imports", "state_name", 10),
        "partner_tornado": lambda s: R.market_share_by_flow(s, 10),
        "ranking_countries_by_exports": lambda s: R.ranking(s, "exports", "country_name"),
        "ranking_states_by_exports": lambda s: R.ranking(s, "exports", "state_name"),
        "ranking_states_by_imports": lambda s: R.ranking(s, "imports", "state_name"),
        "balance_matrix": lambda s: R.matrix(s, "balance", skip_year=2001),
        "category_exports": lambda s: R.by_member(s, ["exports"], [CATEGORY]),
        "category_exports_by_year": lambda s: R.by_member(s, ["exports"], ["year", CATEGORY]),
        "category_imports_by_year": lambda s: R.by_member(s, ["imports"], ["year", CATEGORY]),
        "category_export_price": lambda s: R.by_member(s, ["export_price"], [CATEGORY]),
        "category_import_price": lambda s: R.by_member(s, ["import_price"], [CATEGORY]),
        "yearly_export_price": lambda s: R.by_member(s, ["export_price"], ["year"]),
        "yearly_import_price": lambda s: R.by_member(s, ["import_price"], ["year"]),
        "partners_by_month": R.partners_by_month,
        "active_cities_by_state": R.active_cities_by_state,
        "state_exports_map": lambda s: R.by_member(s, ["exports"], ["state_name"]),
        "state_imports_map": lambda s: R.by_member(s, ["imports", "exports"], ["state_name"]),
        "category_cards": lambda s: R.leader_cards(s, CATEGORY, ["exports", "export_price", "imports", "import_price"]),
        "partner_cards": lambda s: R.leader_cards(s, "country_name", ["exports", "imports"]),
        "state_cards": lambda s: R.leader_cards(s, "state_name", ["exports", "imports"]),
        "data_span": M.data_span,
        "lowest_balance_month": lambda s: R.lowest_month(s, "balance"),
        "top_category_by_year": R.category_leader_by_year,
        "measure_picker_by_month": lambda s: M.measure_picker(
            M.evaluate(s, ["exports", "imports"], ["trade_date"]), ["trade_date"], ["exports", "imports"]
        ),
        "sliced_category_exports": lambda s: R.by_member(
            s, ["exports"], [CATEGORY], FilterContext().where(year=[1997, 1998], region=["ASIA", "EUROPE"])
        ),
        "sliced_country_months": lambda s: R.by_month(s, ["exports", "imports"], FilterContext().where(trade_country_id=["3", "9"])),
        "sliced_city_years": lambda s: R.by_member(
            s, ["exports"], ["year", "region"], FilterContext().where(city_id=["7", "11", "100"], country_name=["NATION_9", "NATION_3"])
        ),
        "sliced_export_share": lambda s: M.share_of_all(
            s, "exports", ["state_name"], FilterContext(date_from=date(1997, 3, 1), date_to=date(1999, 6, 1))
        ),
        "sliced_top_states": lambda s: R.top_members(
            s, "exports", "state_name", 5, FilterContext().where(product_category_name=["SMALL", "PROMO"])
        ),
        "sliced_flag_concentration": lambda s: concentration.hhi(
            s, "country_name", ["year"], FilterContext().where(trade_flag=["imp"])
        ),
        "countries_above_floor": lambda s: R.members_above(s, "exports", "country_name", 50_000_000),
        "countries_outside_top": lambda s: R.members_outside_top(s, "exports", "country_name", 10),
        "state_list_with_others": lambda s: ranking.members_with_others(s.dims["city"], "state_name"),
        "narrative_overview": narrative.overview,
        "narrative_balance": narrative.balance,
        "narrative_products": narrative.products,
        "narrative_partners": narrative.partners,
        "narrative_states": narrative.states,
        "coverage_change_label": lambda s: narrative.coverage_label(s, ["year"]),
        "category_lead_streak": lambda s: timeintel.lead_streak(R.category_leader_by_year(s), "year", CATEGORY),
    }
    return {name: on_star(f) for name, f in q.items()}


def shipping_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full calendar over the shipping dates, with the lines shipped each day."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("Date"))
    per_day = lines.groupBy("Date").agg(F.count(F.lit(1)).alias("lines"))
    days = calendar.calendar(calendar.bounds_of(lines, "Date")).join(per_day, "Date", "left")
    return days.withColumn("lines", F.coalesce("lines", F.lit(0)))


def orders_on_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day first, then the holiday names: the shuffle carries days, not orders."""
    days = read(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    named = days.join(calendar.holidays(calendar.bounds_of(days, "date")), "date")
    return named.groupBy("holiday").agg(F.sum("n").alias("orders"))


def orders_by_business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    value = F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("value")
    days = orders.groupBy(F.col("o_orderdate").cast("date").alias("Date")).agg(F.count(F.lit(1)).alias("n"), value)
    known = calendar.calendar(calendar.bounds_of(days, "Date")).select("Date", "Year", "BusinessDayName")
    groups = days.join(known, "Date").groupBy("Year", "BusinessDayName")
    return groups.agg(F.sum("n").alias("orders"), F.sum("value").cast("decimal(38,2)").alias("value"))


def calendar_queries() -> dict[str, Query]:
    return {
        "shipping_calendar": shipping_calendar,
        "orders_on_holidays": orders_on_holidays,
        "orders_by_business_day": orders_by_business_day,
    }


def all_queries() -> dict[str, Query]:
    return {**report_queries(), **pipeline_queries(), **calendar_queries(), **case_queries(), **upkeep_queries()}
