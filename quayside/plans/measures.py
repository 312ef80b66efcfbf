"""Measures of the star: what each one sums, and how one grouped pass answers many of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.numbers import blank_add, blank_subtract, ratio
from quayside.plans.star import EVERYTHING, FilterContext, Star


def _flag_sum(column: str, flag: str) -> Column:
    return F.sum(F.when(F.col("trade_flag") == flag, F.col(column))).cast("decimal(38,4)" if "real" in column else "decimal(38,2)")


# Sums over fact rows. The flag test sits inside the sum: it replaces, not narrows, a flag slicer.
SUMS: dict[str, Callable[[], Column]] = {
    "exports": lambda: _flag_sum("fob_value", "exp"),
    "imports": lambda: _flag_sum("fob_value", "imp"),
    "export_weight": lambda: _flag_sum("net_weight", "exp"),
    "import_weight": lambda: _flag_sum("net_weight", "imp"),
    "exports_real": lambda: _flag_sum("fob_value_real", "exp"),
    "imports_real": lambda: _flag_sum("fob_value_real", "imp"),
    "total_value": lambda: F.sum("fob_value").cast("decimal(38,2)"),
}

# Measures computed from sums: the sums needed, and the formula on them.
DERIVED: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "flow": (("exports", "imports"), blank_add),
    "balance": (("exports", "imports"), blank_subtract),
    "balance_real": (("exports_real", "imports_real"), blank_subtract),
    "export_price": (("exports", "export_weight"), ratio),
    "import_price": (("imports", "import_weight"), ratio),
    "coverage": (("exports", "imports"), ratio),
}


def sums_for(measures: Iterable[str]) -> list[str]:
    needed: dict[str, None] = {}
    for m in measures:
        for s in DERIVED[m][0] if m in DERIVED else (m,):
            if s not in SUMS:
                raise KeyError(f"no such measure: {m}")
            needed[s] = None
    return list(needed)


def formula(measure: str, column: Callable[[str], Column] = F.col) -> Column:
    """A measure as an expression on the columns holding its sums."""
    if measure in DERIVED:
        sums, f = DERIVED[measure]
        return f(*[column(s) for s in sums])
    return column(measure)


def needs_real(sums: Iterable[str]) -> bool:
    return any("real" in s for s in sums)


def sum_groups(star: Star, sums: list[str], by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """The sums by group, in one pass over the fact."""
    # a flag slicer only matters to sums that do not set the flag themselves
    if "total_value" not in sums:
        ctx = ctx.without("trade_flag")
    return star.grouped(by, {s: SUMS[s]() for s in sums}, ctx, real=needs_real(sums))


def evaluate(star: Star, measures: list[str], by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """One row per group of ``by`` with the asked measures."""
    groups = sum_groups(star, sums_for(measures), by, ctx)
    return groups.select(*by, *[formula(m).alias(m) for m in measures])


def regroup(groups: DataFrame, measures: list[str], by: list[str]) -> DataFrame:
    """Measures by fewer keys, from the sums of finer groups."""
    sums = sums_for(measures)
    rolled = groups.groupBy(*by).agg(*[F.sum(s).cast(groups.schema[s].dataType).alias(s) for s in sums])
    return rolled.select(*by, *[formula(m).alias(m) for m in measures])


def grand_total(star: Star, measure: str) -> Column:
    """The measure over the whole fact, as a scalar subquery."""
    return evaluate(star, [measure], [], EVERYTHING).scalar()


def share_of_all(star: Star, measure: str, by: list[str], ctx: FilterContext = EVERYTHING, out: str = "share") -> DataFrame:
    """Share of the unfiltered total; dates, slicers and groups do not change the denominator."""
    sums = sums_for([measure])
    parts = sum_groups(star, sums, by, ctx)
    groups = parts.select(*by, formula(measure).alias(measure))
    if ctx.empty and by:  # reuses the grouped shuffle; the sums add up, a ratio of them does not
        added = parts.agg(*[F.sum(s).cast(parts.schema[s].dataType).alias(s) for s in sums])
        total = added.select(formula(measure).alias(measure)).scalar()
    else:
        total = grand_total(star, measure)
    return groups.withColumn(out, ratio(F.col(measure), total))


def share_over(star: Star, member: str, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Share of each member in its group's total over all members (a slicer on the member is dropped)."""
    groups = evaluate(star, ["total_value"], [*by, member], ctx.without(member))
    if by:
        totals = groups.groupBy(*[F.col(b).alias(f"_{b}") for b in by]).agg(F.sum("total_value").alias("_total"))
        same = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]  # an unknown member is a group too
        joined = groups.join(totals, same)
        share = joined.withColumn("share", ratio(F.col("total_value"), F.col("_total"))).select(*groups.columns, "share")
    else:
        total = groups.agg(F.sum("total_value")).scalar()
        share = groups.withColumn("share", ratio(F.col("total_value"), total))
    if member in ctx.members:
        share = share.filter(F.col(member).isin(*ctx.members[member]))
    return share


def members_by_flag(star: Star, member: str, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Distinct members with exports and with imports.

    Two grouped steps: (group, member) first with a flag seen on either side, then a count. That
    keeps one copy of every row, where several distinct counts in one step would expand the input.
    """
    seen = star.grouped(
        [*by, member],
        {
            "e": F.max((F.col("trade_flag") == "exp").cast("int")),
            "i": F.max((F.col("trade_flag") == "imp").cast("int")),
        },
        ctx.without("trade_flag"),
        combine=F.max,
    ).filter(F.col(member).isNotNull())
    return seen.groupBy(*by).agg(F.sum("e").alias("exports_members"), F.sum("i").alias("imports_members"))


def data_span(star: Star) -> DataFrame:
    """First and last month of the unfiltered fact."""
    return star.fact().agg(F.min("trade_date").alias("first_month"), F.max("trade_date").alias("last_month"))


def measure_picker(frame: DataFrame, by: list[str], measures: list[str], chosen: list[str] | None = None) -> DataFrame:
    """Measures turned into (measure, value) rows, so a caller can pick them by name."""
    long = frame.unpivot(by, [F.col(m) for m in measures], "measure", "value")
    return long.filter(F.col("measure").isin(*chosen)) if chosen else long
