"""Cleaning rules for landed text records: latest row per key, defaults, name resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.text import normalize_name


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest: str = "loaded_at", ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key; ``ties`` (highest first) make the choice repeatable.

    A ``row_number() = 1`` filter becomes a per-task group limit below the shuffle, so a key with
    millions of copies sends one row per task. The key's hash leads the partitioning: rows are then
    sorted by an 8-byte number instead of comparing several texts, which often start alike.
    """
    order = [F.col(c).desc_nulls_last() for c in (newest, *ties)]
    window = Window.partitionBy("_key", *keys).orderBy(*order)
    numbered = rows.withColumn("_key", F.xxhash64(*keys)).withColumn("_n", F.row_number().over(window))
    return numbered.filter(F.col("_n") == 1).drop("_n", "_key")


def positive(c: Column) -> Column:
    """Quality flag: above zero; a missing value is not."""
    return F.coalesce(c > 0, F.lit(False))


def resolve_name(rows: DataFrame, text: str, members: DataFrame, member_text: str, member_id: str, out: str) -> DataFrame:
    """Left join on the normalised name, adding the member's id as ``out``.

    Members are joined as they come: two members with one normalised name double the rows that
    carry it (see :func:`ambiguous_names`). Which side is broadcast, if any, is left to measured size;
    a name held by a large part of the rows is split by the adaptive skew join. Rows without a name
    match nothing: they get spread keys of their own, so that they are not one hot key of the join.
    """
    names = members.select(normalize_name(F.col(member_text)).alias("_name"), F.col(member_id).alias(out))
    spread = F.concat(F.lit("-"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("string"))  # no name has a "-"
    keyed = rows.withColumn("_name", F.coalesce(normalize_name(F.col(text)), spread))
    return keyed.join(names, "_name", "left").drop("_name")


def shares_unknown(members: Mapping[str, str]) -> Column:
    """Whether a row has an unknown member in one of these columns (column -> the unknown member)."""
    tests = [F.col(c) == unknown for c, unknown in members.items()]
    return reduce(lambda a, b: a | b, tests)


def sum_unknown(rows: DataFrame, keys: Sequence[str], record: Sequence[str], members: Mapping[str, str], sums: Sequence[str]) -> DataFrame:
    """Rows that share a key only because their names were not found, summed into one row with their number in ``records``.

    ``record`` are the names as they came. Two rows of one key and one record are the same record twice, and so are two
    rows whose members are all known: those stay as they are, for the key test to find. Other columns get their greatest
    value. Known rows pass as they are; only unknown ones, usually few, are sorted and grouped. ``rows`` is read twice.
    """
    unknown = F.coalesce(shares_unknown(members), F.lit(False))
    kept = [c for c in rows.columns if c not in record]
    known = rows.filter(~unknown).select(*kept, F.lit(1).cast("bigint").alias("records"))
    once = rows.filter(unknown).withColumn("_copies", F.row_number().over(Window.partitionBy(*keys, *record).orderBy(*sums)))
    others = [c for c in kept if c not in {*keys, *sums}]
    groups = once.groupBy(*keys, "_copies").agg(
        *[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums], *[F.max(c).alias(c) for c in others], F.count("*").alias("records")
    )
    return known.unionByName(groups.select(*kept, "records"))


def ambiguous_names(members: DataFrame, member_text: str, member_id: str) -> DataFrame:
    """Normalised names shared by more than one member."""
    names = members.select(normalize_name(F.col(member_text)).alias("normalized"), F.col(member_id).alias("id")).distinct()
    return names.groupBy("normalized").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1)


def all_as_text(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but ``keep`` as string."""
    return rows.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in rows.columns])


def heading_filter(code: Column, prefix: str = "03", not_suffix: str = "09") -> Column:
    """Codes of one chapter without its catch-all heading."""
    return code.startswith(prefix) & ~code.endswith(not_suffix)
