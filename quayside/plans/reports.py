"""The report queries: one grouped question over the star per visual."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.numbers import blank_subtract, ratio
from quayside.operators.concentration import BAND_WIDTHS, band, hhi, squared_shares
from quayside.operators.ranking import (
    OTHERS,
    dense_rank_of,
    leaders_by,
    top_n,
    top_n_others,
)
from quayside.operators.timeintel import running_total, with_last_year
from quayside.plans.measures import (
    evaluate,
    formula,
    members_by_flag,
    share_of_all,
    sum_groups,
    sums_for,
)
from quayside.plans.star import EVERYTHING, FilterContext, Star

CATEGORY = "product_category_name"


def by_month(star: Star, measures: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    return evaluate(star, measures, ["trade_date"], ctx).orderBy("trade_date")


def by_member(star: Star, measures: list[str], by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Measures by member, largest first measure on top; groups without it are not shown."""
    shown = evaluate(star, measures, by, ctx).filter(F.col(measures[0]).isNotNull())
    return shown.orderBy(F.col(measures[0]).desc(), *by)


def totals(star: Star, measures: list[str], by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Measures at every level of ``by``: groups, subtotals of every subset, and the total.

    ``level`` is the grouping id (0 for full groups). The cube runs on grouped sums, not on facts.
    """
    sums = sums_for(measures)
    groups = sum_groups(star, sums, by, ctx)
    cube = groups.cube(*by).agg(
        F.grouping_id().cast("int").alias("level"),
        *[F.sum(s).cast(groups.schema[s].dataType).alias(s) for s in sums],
    )
    return cube.select("level", *by, *[formula(m).alias(m) for m in measures])


def matrix(star: Star, measure: str, ctx: FilterContext = EVERYTHING, skip_year: int | None = None) -> DataFrame:
    """Year by month-of-year matrix of one measure."""
    groups = evaluate(star, [measure], ["year", "month"], ctx)
    if skip_year is not None:
        groups = groups.filter(F.col("year") != skip_year)
    wide = groups.groupBy("year").pivot("month", list(range(1, 13))).agg(F.first(measure))
    return wide.withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)}).orderBy("year")


def export_import_shares(star: Star, groups: DataFrame, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Groups with their shares of all exports and imports; both totals come from one subquery."""
    whole = groups if ctx.empty else evaluate(star, ["exports", "imports"], [])
    totals = whole.agg(F.struct(F.sum("exports").alias("e"), F.sum("imports").alias("i"))).scalar()
    shares = {
        "export_share": ratio(F.col("exports"), F.col("_totals.e")),
        "import_share": ratio(F.col("imports"), F.col("_totals.i")),
    }
    return groups.withColumn("_totals", totals).withColumns(shares).drop("_totals")


def market_share_by_flow(star: Star, n: int, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Import and export shares of the n countries with most trade flow; imports drawn to the left."""
    groups = evaluate(star, ["flow", "exports", "imports"], ["country_name"], ctx)
    shares = export_import_shares(star, groups, ctx)
    best = top_n(shares, "flow", n, member="country_name").withColumn("import_share_left", -F.col("import_share"))
    return best.select("country_name", "flow", "export_share", "import_share", "import_share_left").orderBy(
        F.col("export_share").desc()
    )


def top_members(star: Star, measure: str, member: str, n: int, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """The n best members. The ranking ignores a slicer on the member itself; the result keeps it."""
    groups = evaluate(star, [measure], [member], ctx.without(member))
    best = top_n(groups, measure, n, member=member)
    if member in ctx.members:
        best = best.filter(F.col(member).isin(*ctx.members[member]))
    return best.orderBy(F.col(measure).desc(), member)


def top_shares_others(star: Star, measure: str, member: str, n: int, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Shares of the total: the n best members and one row for the rest, which comes last."""
    rows = top_n_others(share_of_all(star, measure, [member], ctx.without(member)), member, "share", n)
    return rows.orderBy(F.col(member) == OTHERS, F.col("share").desc())


def top_squared_shares_others(star: Star, measure: str, member: str, n: int, ctx: FilterContext = EVERYTHING) -> DataFrame:
    rows = top_n_others(squared_shares(star, measure, member, ctx=ctx.without(member)), member, "squared_share", n)
    return rows.orderBy(F.col(member) == OTHERS, F.col("squared_share").desc())


def ranking(star: Star, measure: str, member: str, ctx: FilterContext = EVERYTHING) -> DataFrame:
    return dense_rank_of(evaluate(star, [measure], [member], ctx), measure).orderBy("ranking", member)


def concentration_by_year(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    return hhi(star, "country_name", ["year"], ctx).withColumn("band", band(F.col("hhi"))).orderBy("year")


def year_over_year(star: Star, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Values beside those of the year before: rates for flows and prices, differences for balances."""
    measures = ["exports", "imports", "flow", "balance", "export_price", "coverage"]
    frame = with_last_year(star, measures, by, ctx)
    for m in ("exports", "imports", "flow", "export_price"):
        now, ago = F.col(m), F.col(f"{m}_ly")
        frame = frame.withColumn(f"{m}_yoy", ratio(blank_subtract(now, ago), ago))
    for m in ("balance", "coverage"):
        frame = frame.withColumn(f"{m}_yoy", blank_subtract(F.col(m), F.col(f"{m}_ly")))
    return frame.orderBy(*by)


def running_totals(star: Star, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    return running_total(star, ["exports", "imports"], by, ctx).orderBy(*by)


def partners_by_month(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    return members_by_flag(star, "trade_country_id", ["trade_date"], ctx).orderBy("trade_date")


def active_cities_by_state(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    return members_by_flag(star, "city_id", ["state_name"], ctx).orderBy(F.col("exports_members").desc(), "state_name")


def leader_cards(star: Star, member: str, measures: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """One row per measure: the member leading it (tied names joined), with its value."""
    groups = evaluate(star, measures, [member], ctx)
    long = groups.unpivot([member], [F.col(m).cast("double").alias(m) for m in measures], "measure", "value")
    return leaders_by(long, "measure", member, "value")


def category_leader_by_year(star: Star, measure: str = "exports", ctx: FilterContext = EVERYTHING) -> DataFrame:
    return leaders_by(evaluate(star, [measure], ["year", CATEGORY], ctx), "year", CATEGORY, measure).orderBy("year")


def lowest_month(star: Star, measure: str = "balance", ctx: FilterContext = EVERYTHING) -> DataFrame:
    """The month (all of them, when tied) with the lowest value."""
    return top_n(evaluate(star, [measure], ["trade_date"], ctx), measure, 1, ascending=True)


def by_month_label(star: Star, measures: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Measures by month label, in the order of the month's number: the pair stays in the keys."""
    return evaluate(star, measures, ["month_number", "month_name"], ctx).orderBy("month_number")


def concentration_gauge(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Overall concentration over countries, its band, and the widths of the three stacked bands."""
    widths = [F.lit(w).alias(f"{name}_width") for name, w in BAND_WIDTHS.items()]
    return hhi(star, "country_name", [], ctx).select("hhi", band(F.col("hhi")).alias("band"), *widths)


def top_n_choices(spark: SparkSession, last: int = 20) -> DataFrame:
    """The numbers a top-N slicer offers."""
    return spark.range(1, last + 1).select(F.col("id").cast("int").alias("n"))


def members_above(star: Star, measure: str, member: str, floor: float, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Members whose measure is above a floor: aggregate first, then filter."""
    return evaluate(star, [measure], [member], ctx).filter(F.col(measure) > floor).orderBy(member)


def members_outside_top(star: Star, measure: str, member: str, n: int, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """All members except the n best."""
    groups = evaluate(star, [measure], [member], ctx)
    best = top_n(groups, measure, n, member=member).select(member)
    return groups.select(member).join(best, member, "left_anti").orderBy(member)
