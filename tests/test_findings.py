"""Inputs that the order tables do not hold: far months, other alphabets, doubled members, growing partitions, plans."""

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quayside.functions.text import normalize_name
from quayside.operators import inflation, ranking
from quayside.operators.incremental import DuplicateKeys
from quayside.plans import measures as M
from quayside.plans.star import FilterContext
from quayside.plans.table_star import table_star
from quayside.sources import partitioned, tables
from quayside.streaming.load import load_landed


def test_months_of_any_year_have_an_index(spark):
    days = [dt.date(1899, 1, 1), dt.date(2024, 1, 1), dt.date(2100, 1, 1)]
    index = spark.createDataFrame([(d, D("50.00")) for d in days], "cpi_date date, cpi_value decimal(20,2)")
    trades = spark.createDataFrame([(d, D("2.00")) for d in days], "trade_date date, fob_value decimal(20,2)")
    assert [r.fob_value_real for r in inflation.deflate(trades, index).collect()] == [D("2.0000")] * 3


def test_names_of_all_latin_letters(spark):
    rows = spark.createDataFrame([("Škoda Łódź Žilina", "skodalodzzilina"), ("Đặng Thị Ệ", "dangthie"), ("Þór Æsir Ĳ Œuvre ẞ", "thoraesirijoeuvress")], "t string, n string")
    assert rows.filter(normalize_name(F.col("t")) != F.col("n")).count() == 0


def test_partition_keeps_new_columns_and_text_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    partitioned.upsert(spark, path, make([(1, "0301"), (2, "0302")], "k int, h string"), ["k", "h"], "h")
    partitioned.upsert(spark, path, make([(1, "0301", "x")], "k int, h string, note string"), ["k", "h"], "h")
    partitioned.upsert(spark, path, make([(3, "0301")], "k int, h string"), ["k", "h"], "h")
    got = sorted(map(tuple, partitioned.read(spark, path).select("k", "h", "note").collect()))
    assert got == [(1, "0301", "x"), (2, "0302", None), (3, "0301", None)]


def test_older_copy_in_a_later_file_changes_nothing(spark, tmp_path):
    schema = "k int, p string, v string, loaded_at int"
    for stamp in (2, 1):
        spark.createDataFrame([(1, "a", f"v{stamp}", stamp)], schema).write.mode("append").parquet(str(tmp_path / "landing"))
        load_landed(spark, str(tmp_path / "landing"), schema, str(tmp_path / "t"), str(tmp_path / "c"), ["k", "p"], "p", "loaded_at", files_per_batch=1)
    assert [r.v for r in partitioned.read(spark, str(tmp_path / "t")).collect()] == ["v2"]


def test_doubled_members_are_refused(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(DuplicateKeys):
        tables.insert_new_version(spark, str(tmp_path / "d"), twice, "k")


def test_unknown_member_takes_no_place(spark):
    groups = spark.createDataFrame([("a", 5), ("b", 3), (None, 9), ("c", 1)], "m string, v int")
    assert {tuple(r) for r in ranking.top_n_others(groups, "m", "v", 2).collect()} == {("a", 5), ("b", 3), ("Outros", 10)}
    assert {tuple(r) for r in ranking.top_n(groups, "v", 2, member="m").collect()} == {("a", 5), ("b", 3)}


def _plan(frame) -> str:
    return re.sub(r"#\d+L?", "", frame._jdf.queryExecution().optimizedPlan().toString())


def test_slicer_cuts_below_the_grouping(spark, sf):
    star = table_star(spark, sf)
    plan = _plan(M.evaluate(star, ["exports"], ["year"], FilterContext().where(region=["ASIA"])))
    lines = plan.splitlines()
    grouping = next(i for i, x in enumerate(lines) if "Aggregate" in x)
    assert any("LeftSemi" in x for x in lines[grouping:]) and plan.count("Aggregate") == 1


def test_period_and_mapped_key_group_once(spark, sf):
    plan = _plan(M.evaluate(table_star(spark, sf), ["exports"], ["year", "trade_country_id"]))
    assert plan.count("Aggregate") == 1
