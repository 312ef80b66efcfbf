"""One key holding most rows, and plans that keep it spread."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.operators import cleansing, quality, ranking
from quayside.plans.catalog import all_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_on_a_hot_key(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("loaded_at")
    )
    newest = cleansing.latest_per_key(rows, ["k"])
    assert newest.filter("k = 'hot'").first().loaded_at == 29_997
    assert newest.count() == 20_001
    text = plan(newest)
    assert text.index("WindowGroupLimit", text.index("Exchange")) > 0  # a limit below the shuffle too
    assert text.count("WindowGroupLimit") == 2


def test_top_n_with_a_third_tied(spark):
    g = spark.range(9_000).select(F.col("id").alias("m"), F.when(F.col("id") % 3 == 0, 10_000).otherwise(F.col("id")).cast("decimal(20,2)").alias("v"))
    best = ranking.top_n(g, "v", 5)
    assert best.count() == 3_000
    assert "Window" not in plan(best)


def test_dense_rank_with_a_third_tied(spark):
    g = spark.range(9_000).select(F.col("id").alias("m"), F.when(F.col("id") % 3 == 0, 10_000).otherwise(F.col("id")).cast("decimal(20,2)").alias("v"))
    ranked = ranking.dense_rank_of(g, "v")
    assert ranked.filter("ranking = 1").count() == 3_000
    assert ranked.agg(F.max("ranking")).first()[0] == 6_001


def test_relationships_counts_rows_of_a_hot_orphan(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, "lost").otherwise("known").alias("fk"))
    parents = spark.createDataFrame([("known",)], "pk string")
    assert quality.relationships(rows, "t", "fk", parents, "pk").first().failures == 3_000


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join(spark, sf, name):
    text = plan(all_queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_slicer_reaches_the_scan(spark, sf):
    text = plan(all_queries()["sliced_export_share"](spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in text and "l_comment" not in text


def test_monthly_balance_reads_three_columns(spark, sf):
    text = plan(all_queries()["monthly_trade_balance"](spark, sf))
    assert "ReadSchema: struct<l_extendedprice:double,l_linestatus:string,l_shipdate:timestamp_ntz>" in text


def test_sums_are_exact_whatever_the_partitions(spark):
    rows = spark.range(1000).select(F.lit(Decimal("0.10")).cast("decimal(20,2)").alias("v"))
    totals = {rows.repartition(n).agg(F.sum("v")).first()[0] for n in (1, 7, 16)}
    assert totals == {Decimal("100.00")}
