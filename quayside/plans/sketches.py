"""Distinct members from stored sketches: one per month, direction and slicer attribute, merged for any slice.

A sketch has 2^``PRECISION`` registers. Its relative standard error is 1.04 / sqrt(2^PRECISION), 0.8 % for 14; few members
(some hundreds) are kept as they are and counted exactly. A merged sketch has the error of a single one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.plans.star import EVERYTHING, PERIODS, FilterContext, Star, with_periods

PRECISION = 14
FLAGS = {"exp": "exports", "imp": "imports"}


def relative_error(precision: int = PRECISION) -> float:
    """One standard error, as a share of the number estimated."""
    return 1.04 / 2 ** (precision / 2)


def member_sketches(star: Star, member: str, by: list[str], precision: int = PRECISION) -> DataFrame:
    """(trade_date, *by, trade_flag, members): to be written once and kept; ``by`` holds the attributes slicers may use.

    Facts are grouped to one row for each member first, so that no sketch is made for a finer group than asked.
    """
    seen = {f: F.max((F.col("trade_flag") == f).cast("int")) for f in FLAGS}
    groups = star.grouped(["trade_date", *by, member], seen, combine=F.max).filter(F.col(member).isNotNull())
    long = groups.unpivot(["trade_date", *by, member], list(FLAGS), "trade_flag", "seen").filter("seen = 1")
    return long.groupBy("trade_date", *by, "trade_flag").agg(F.hll_sketch_agg(member, precision).alias("members"))


def estimated_members(sketches: DataFrame, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """(*by, exports_members, imports_members) of a slice, from sketches alone; ``by`` and the choices are attributes or
    periods that the sketches have."""
    rows = with_periods(sketches, {*by, *ctx.members})
    lo, hi = ctx.bounds()
    if lo is not None:
        rows = rows.filter(F.col("trade_date") >= F.lit(lo))
    if hi is not None:
        rows = rows.filter(F.col("trade_date") <= F.lit(hi))
    for attribute, chosen in ctx.members.items():
        if attribute != "trade_flag":
            rows = rows.filter(F.col(attribute).isin(*chosen))
    missing = [b for b in by if b not in rows.columns and b not in PERIODS]
    if missing:
        raise KeyError(f"the sketches have no {missing}")

    def estimate(flag: str) -> Column:
        merged = F.hll_union_agg(F.when(F.col("trade_flag") == flag, F.col("members")))
        return F.coalesce(F.hll_sketch_estimate(merged), F.lit(0)).alias(f"{FLAGS[flag]}_members")

    return rows.groupBy(*by).agg(*[estimate(f) for f in FLAGS])


def with_bound(exact: DataFrame, estimated: DataFrame, by: list[str], precision: int = PRECISION, errors: float = 3.0) -> DataFrame:
    """Exact numbers, estimates, and whether each lies within so many standard errors (one member at least)."""
    found = exact.join(estimated.withColumnsRenamed({f"{n}_members": f"{n}_estimate" for n in FLAGS.values()}), by)
    for n in FLAGS.values():
        off = F.abs(F.col(f"{n}_members") - F.col(f"{n}_estimate"))
        found = found.withColumn(f"{n}_within", off <= F.greatest(F.lit(1.0), errors * relative_error(precision) * F.col(f"{n}_members")))
    return found
