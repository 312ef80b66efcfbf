"""Running totals, same period last year, and lead streaks on month-grain aggregates.

Every function first brings the fact to month (or year) grain; the windows below then see at most
one row per member and period, whatever the size of the fact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import year_end
from quayside.plans.measures import formula, sum_groups, sums_for
from quayside.plans.star import EVERYTHING, PERIODS, FilterContext, Star, in_dates, with_periods

TIME = ("trade_date", *PERIODS)


def last_day(star: Star, groups: DataFrame, period: str, ctx: FilterContext, as_of: date | None) -> Column:
    """End of the calendar: 31 December of the as-of year, or of the latest fact when not given.

    Without filters the latest fact is read off the grouped rows; only a filter costs another scan.
    """
    if as_of is not None:
        return F.lit(date(as_of.year, 12, 31))
    if not ctx.empty:
        return star.fact().agg(year_end(F.max("trade_date"))).scalar()
    latest = F.max(period)
    return groups.agg(F.make_date(latest if period == "year" else F.year(latest), F.lit(12), F.lit(31))).scalar()


def _back_a_year(d: date | None) -> date | None:
    return date(d.year - 1, d.month, 1) if d else None


def with_last_year(
    star: Star, measures: list[str], by: list[str], ctx: FilterContext = EVERYTHING, as_of: date | None = None
) -> DataFrame:
    """Each measure beside its value one year earlier (``<m>_ly``).

    The calendar is shifted, not the data: an unfinished year meets the whole year before it. Every
    month total is emitted twice, at its own month and twelve months later, and regrouped: one scan
    and no self join.
    """
    sums = sums_for(measures)
    others = [b for b in by if b not in TIME]
    lo, hi = ctx.bounds()
    wide = FilterContext({k: v for k, v in ctx.members.items() if k not in TIME}, _back_a_year(lo), hi)
    monthly = sum_groups(star, sums, [*others, "trade_date"], wide)
    shifts = F.array(
        F.struct(F.lit(0).alias("lag"), F.col("trade_date").alias("at")),
        F.struct(F.lit(1).alias("lag"), F.add_months("trade_date", 12).alias("at")),
    )
    twice = monthly.withColumn("s", F.explode(shifts)).withColumns({"trade_date": F.col("s.at"), "lag": F.col("s.lag")})
    kept = twice.filter(in_dates(ctx) & (F.col("trade_date") <= last_day(star, monthly, "trade_date", ctx, as_of)))
    kept = with_periods(kept, by)

    def at(lag: int) -> list[Column]:
        return [
            F.sum(F.when(F.col("lag") == lag, F.col(s))).cast(monthly.schema[s].dataType).alias(f"{s}@{lag}")
            for s in sums
        ]

    groups = kept.groupBy(*by).agg(*at(0), *at(1))
    now = [formula(m, lambda s: F.col(f"`{s}@0`")).alias(m) for m in measures]
    ago = [formula(m, lambda s: F.col(f"`{s}@1`")).alias(f"{m}_ly") for m in measures]
    return groups.select(*by, *now, *ago)


def running_total(
    star: Star, measures: list[str], by: list[str], ctx: FilterContext = EVERYTHING, as_of: date | None = None
) -> DataFrame:
    """Each measure summed from the first date to the end of the period (``<m>_acc``).

    A period without trades repeats the total before it: each row is stretched up to the member's
    next period. The lower end of the date slicer limits the rows shown, not the sums.
    """
    period = "year" if "year" in by else "trade_date"
    others = [b for b in by if b != period]
    sums = sums_for(measures)
    groups = sum_groups(star, sums, [*others, period], ctx.without_lower_date())
    order = Window.partitionBy(*others).orderBy(period)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = last_day(star, groups, period, ctx, as_of)
    if ctx.bounds()[1] is not None:
        end = F.least(end, F.lit(ctx.bounds()[1]))
    if period == "year":
        until = F.coalesce(F.lead(period).over(order) - 1, F.year(end))
        stretch = F.sequence(F.col(period), F.greatest(until, F.col(period)))
    else:
        until = F.coalesce(F.add_months(F.lead(period).over(order), -1), F.trunc(end, "month"))
        stretch = F.sequence(F.col(period), F.greatest(until, F.col(period)), F.expr("interval 1 month"))
    totals = groups.withColumns({s: F.sum(s).over(so_far) for s in sums} | {"_stretch": stretch})
    filled = totals.withColumn(period, F.explode("_stretch")).drop("_stretch")
    if period == "year":
        lo = ctx.bounds()[0]
        filled = filled.filter(F.col("year") >= lo.year) if lo else filled
    else:
        filled = filled.filter(in_dates(ctx))
    return filled.select(*by, *[formula(m).alias(f"{m}_acc") for m in measures])


def span_of(star: Star, measure: str, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """First and last month in which the measure is above zero."""
    monthly = sum_groups(star, sums_for([measure]), ["trade_date"], ctx).withColumn("_v", formula(measure))
    active = F.when(F.col("_v") > 0, F.col("trade_date"))
    return monthly.agg(F.min(active).alias("first_month"), F.max(active).alias("last_month"))


def lead_streak(leaders: DataFrame, period: str, member: str) -> DataFrame:
    """Latest leader and the number of consecutive periods it has led.

    ``leaders`` holds one row per period. When the leader never changed, all periods count.
    """
    latest = leaders.agg(F.max_by(member, period)).scalar()
    same = F.col(member).eqNullSafe(latest)
    return leaders.agg(
        F.max_by(member, period).alias(member),
        (
            F.max(period) - F.coalesce(F.max(F.when(~same, F.col(period))), F.min(period) - 1)
        ).cast("int").alias("periods_in_lead"),
    )
