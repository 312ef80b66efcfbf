"""Declarative data tests. Every test gives (table_name, test, column_name, failures)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """At least one data test failed."""


def _result(frame: DataFrame, table: str, test: str, column: str, failures) -> DataFrame:
    return frame.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"
    )


def not_null(frame: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Missing values of all columns, counted in one pass."""
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), F.lit("not_null").alias("test"), "column_name", "failures")


def unique(frame: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; rows with a missing key part are ignored."""
    known = frame.select(*columns).dropna(how="any")
    twice = known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _result(twice, table, "unique", ", ".join(columns), F.count(F.lit(1)))


def relationships(frame: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; missing keys are ignored. Keys are counted before the anti join."""
    keys = frame.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
    return _result(orphans, table, "relationships", column, F.sum("n"))


def suite(frame: DataFrame, table: str, columns: Sequence[str], keys: Sequence[str] = (), parents: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """:func:`not_null`, :func:`unique` and :func:`relationships` of a table from one read of it.

    Rows are grouped by the key, with its copies and missing values counted, which is the exchange the key test needs
    anyway. Each group then gives one row for the totals and one for each foreign key, which are summed by value
    before any exchange and meet the parents' keys in one join. A foreign key outside the key is tested by itself.
    """
    others = {fk: p for fk, p in (parents or {}).items() if fk not in keys}
    parents = {fk: p for fk, p in (parents or {}).items() if fk in keys}
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)]
    groups = frame.groupBy(*keys).agg(F.count("*").alias("_n"), *nulls) if keys else frame.agg(F.count("*").alias("_n"), *nulls)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    twice = (known & (F.col("_n") > 1)).cast("long") if keys else F.lit(0).cast("long")
    counts = [F.col(f"_null_{i}").cast("long") for i in range(len(columns))]
    none = F.lit(0).cast("long")
    rows = [F.struct(F.lit("").alias("fk"), F.lit(None).cast("string").alias("value"), none.alias("n"), twice.alias("twice"), *[c.alias(f"c{i}") for i, c in enumerate(counts)])]
    for fk in parents:
        rows.append(F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("value"), F.col("_n").cast("long").alias("n"), none.alias("twice"), *[none.alias(f"c{i}") for i in range(len(counts))]))
    summed = ["n", "twice", *[f"c{i}" for i in range(len(counts))]]
    each = groups.select(F.inline(F.array(*rows))).groupBy("fk", "value").agg(*[F.sum(c).alias(c) for c in summed])
    if parents:
        known_keys = reduce(DataFrame.unionByName, [p.select(F.lit(fk).alias("fk"), F.col(k).cast("string").alias("value")) for fk, (p, k) in parents.items()])
        each = each.join(known_keys.distinct().withColumn("found", F.lit(1)), ["fk", "value"], "left")
        lost = F.when(F.col("found").isNull() & F.col("value").isNotNull(), F.col("n"))
    else:
        lost = none
    total = each.agg(*[F.sum(c).alias(c) for c in summed[1:]], *[F.sum(F.when(F.col("fk") == fk, lost)).alias(f"fk{i}") for i, fk in enumerate(parents)])
    tests = [("not_null", c, f"c{i}") for i, c in enumerate(columns)] + ([("unique", ", ".join(keys), "twice")] if keys else [])
    tests += [("relationships", fk, f"fk{i}") for i, fk in enumerate(parents)]
    found = [F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.coalesce(F.col(v), none).alias("failures")) for t, c, v in tests]
    once = total.select(F.inline(F.array(*found))).select(F.lit(table).alias("table_name"), "test", "column_name", "failures")
    return report(once, *[relationships(frame, table, fk, *p) for fk, p in others.items()])


def cut_values(frame: DataFrame, table: str, widths: Mapping[str, int]) -> DataFrame:
    """Values longer than the width their column is cut to: (table_name, column_name, value, length, kept, rows).

    Two of them may become one after the cut; trailing blanks carry no meaning. Only long values are grouped.
    """
    texts = F.create_map(*[x for c in widths for x in (F.lit(c), F.rtrim(F.col(c).cast("string")))])
    limits = F.create_map(*[x for c, w in widths.items() for x in (F.lit(c), F.lit(w))])
    each = frame.select(F.explode(texts).alias("column_name", "value")).withColumn("width", limits[F.col("column_name")])
    long = each.filter(F.char_length("value") > F.col("width"))
    kept = F.substring(F.col("value"), F.lit(1), F.col("width")).alias("kept")
    groups = long.groupBy("column_name", "value", "width").agg(F.count("*").alias("rows"))
    return groups.select(F.lit(table).alias("table_name"), "column_name", "value", F.char_length("value").alias("length"), kept, "rows")


def widths_fit(frame: DataFrame, table: str, widths: Mapping[str, int]) -> DataFrame:
    """Rows with a value that would be cut, for each column."""
    counts = frame.agg(*[F.count_if(F.char_length(F.rtrim(F.col(c).cast("string"))) > w).alias(c) for c, w in widths.items()])
    long = counts.unpivot([], list(widths), "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), F.lit("width").alias("test"), "column_name", "failures")


def report(*tests: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tests)


def gate(results: DataFrame) -> None:
    """Stop the run when a test failed. One row per failed test reaches the driver."""
    failed = results.filter(F.col("failures") > 0).collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed))


def with_unknown_member(dimension: DataFrame, key: str, unknown: str = "N/A", **values: Column) -> DataFrame:
    """The dimension plus one member for facts whose name matched nothing.

    Text columns hold ``unknown``, others are empty unless given in ``values``.
    """
    spark = dimension.sparkSession

    def cell(name: str, kind) -> Column:
        text = name == key or kind.typeName() == "string"
        return values.get(name, F.lit(unknown if text else None)).cast(kind).alias(name)

    return dimension.unionByName(spark.range(1).select(*[cell(f.name, f.dataType) for f in dimension.schema]))
