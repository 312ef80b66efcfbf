"""Top-N with ties, the Others row, dense ranks and leaders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OTHERS = "Outros"


def cut_off(groups: DataFrame, value: str, n: int, ascending: bool = False, member: str | None = None) -> Column:
    """The n-th best value, as a scalar subquery; with ``member`` an unknown (NULL) one takes no place.

    ``orderBy().limit(n)`` keeps n rows per task and n in the end, whatever the number of members
    or ties; a rank over all members would sort them in a single task.
    """
    order = F.col(value).asc() if ascending else F.col(value).desc()
    known = groups.filter(F.col(value).isNotNull() & (F.col(member).isNotNull() if member else F.lit(True)))
    best = known.select(value).orderBy(order).limit(n)
    return best.agg((F.max if ascending else F.min)(value)).scalar()


def top_n(groups: DataFrame, value: str, n: int, ascending: bool = False, member: str | None = None) -> DataFrame:
    """Members among the n best; all members tied at rank n stay. With ``member`` the unknown one is left out."""
    limit = cut_off(groups, value, n, ascending, member)
    best = groups.filter(F.col(value) <= limit if ascending else F.col(value) >= limit)
    return best.filter(F.col(member).isNotNull()) if member else best


def top_n_per_group(groups: DataFrame, by: list[str], value: str, n: int) -> DataFrame:
    """Top-n inside each group, ties kept.

    The rank filter is pushed below the shuffle as a per-task group limit, so at most the n best
    (and their ties) of each task travel.
    """
    order = Window.partitionBy(*by).orderBy(F.col(value).desc())
    ranked = groups.filter(F.col(value).isNotNull()).withColumn("_rank", F.rank().over(order))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def top_n_others(groups: DataFrame, member: str, value: str, n: int, rank_by: str | None = None) -> DataFrame:
    """The n best members by name and one row for the sum of the rest, the unknown member among them."""
    rank_by = rank_by or value
    limit = cut_off(groups, rank_by, n, member=member)
    name = F.when(F.col(member).isNotNull() & (F.col(rank_by) >= limit), F.col(member)).otherwise(F.lit(OTHERS))
    return groups.groupBy(name.alias(member)).agg(F.sum(value).alias(value)).filter(F.col(value).isNotNull())


def members_with_others(members: DataFrame, member: str) -> DataFrame:
    """The distinct members and the Others row, for a slicer list."""
    names = members.select(member).filter(F.col(member).isNotNull()).distinct()
    spark = members.sparkSession
    return names.unionByName(spark.range(1).select(F.lit(OTHERS).alias(member)))


def dense_rank_of(groups: DataFrame, value: str, out: str = "ranking", slices: int | None = None) -> DataFrame:
    """Dense rank over all members, highest value first, missing values last.

    Distinct values are cut into ranges at approximate quantiles (as many as shuffle partitions, 64 at
    least, unless given) and ranked range by range; the
    number of distinct values in higher ranges (at most ``slices`` rows) is then added. Exact, and
    no task ever sees all values.
    """
    values = groups.select(F.col(value).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    partitions = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(slices or max(64, partitions), 2)
    points = [i / slices for i in range(1, slices)]
    bounds = values.agg(F.percentile_approx("_v", points).alias("b")).scalar()
    sliced = values.withColumn("_b", bounds).select(
        "_v", F.size(F.filter("_b", lambda b: b < F.col("_v"))).alias("_slice")
    )
    inside = sliced.withColumn("_pos", F.row_number().over(Window.partitionBy("_slice").orderBy(F.col("_v").desc())))
    above = Window.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    ranks = inside.join(offsets, "_slice").select("_v", (F.col("_pos") + F.col("_above")).cast("int").alias(out))
    last = values.agg((F.count(F.lit(1)) + 1).cast("int")).scalar()
    return (
        groups.join(ranks, F.col(value) == F.col("_v"), "left")
        .drop("_v")
        .withColumn(out, F.coalesce(F.col(out), last))
    )


def first_member(groups: DataFrame, member: str, value: str) -> DataFrame:
    """The single best member: highest value, then first name."""
    picked = groups.filter(F.col(value).isNotNull())
    order = [F.col(value).desc(), F.col(member).asc_nulls_last()]
    return picked.select(member, value).orderBy(*order).limit(1)


def leaders(groups: DataFrame, member: str, value: str) -> DataFrame:
    """(member, value) in one row: every member tied for the highest value, names joined.

    Meant for the leaders of a dimension; many ties are better read as rows from :func:`top_n`.
    """
    best = top_n(groups, value, 1)
    return best.agg(
        F.array_join(F.sort_array(F.collect_list(member)), "").alias(member), F.max(value).alias(value)
    )


def leaders_by(groups: DataFrame, by: str, member: str, value: str) -> DataFrame:
    """The leader (ties joined) of each period."""
    best = top_n_per_group(groups, [by], value, 1)
    return best.groupBy(by).agg(
        F.array_join(F.sort_array(F.collect_list(member)), "").alias(member), F.max(value).alias(value)
    )
