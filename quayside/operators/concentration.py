"""Herfindahl-Hirschman concentration over members of a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.numbers import ratio
from quayside.plans.measures import evaluate, share_of_all
from quayside.plans.star import EVERYTHING, FilterContext, Star

# Upper ends of the low and medium bands, and the widths of the three stacked bands.
LOW, MEDIUM = 0.15, 0.25
BAND_WIDTHS = {"low": 0.15, "medium": 0.10, "high": 0.75}


def hhi(star: Star, member: str, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Sum of squared member shares in each group.

    Written as sum(v * v) / sum(v) squared: two plain aggregates over member totals, without a
    window holding a whole group.
    """
    groups = evaluate(star, ["total_value"], [*by, member], ctx).withColumn("v", F.col("total_value").cast("double"))
    return groups.groupBy(*by).agg(ratio(F.sum(F.col("v") * F.col("v")), F.sum("v") * F.sum("v")).alias("hhi"))


def squared_shares(
    star: Star, measure: str, member: str, by: list[str] | None = None, ctx: FilterContext = EVERYTHING
) -> DataFrame:
    """Squared share of the unfiltered total for each member."""
    shares = share_of_all(star, measure, [*(by or []), member], ctx)
    return shares.withColumn("squared_share", F.col("share") * F.col("share"))


def hhi_of_total(star: Star, measure: str, member: str, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Sum over members of squared shares of the unfiltered total."""
    return squared_shares(star, measure, member, by, ctx).groupBy(*by).agg(F.sum("squared_share").alias("hhi"))


def band(value: Column) -> Column:
    return F.when(value <= LOW, "low").when(value <= MEDIUM, "medium").when(value.isNotNull(), "high")
