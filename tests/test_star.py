"""Measures, filter context, rankings and time comparisons on a small star."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quayside.operators import concentration, ranking, timeintel
from quayside.plans import measures as M
from quayside.plans import sketches
from quayside.plans import reports as R
from quayside.plans.star import Bridge, FilterContext, Star

FACT = "trade_date date, city_id string, trade_country_id string, product_category_id string, fob_value decimal(20,2), net_weight decimal(20,2), trade_flag string, fob_value_real decimal(38,4)"


def make(spark, rows):
    data = [(dt.date.fromisoformat(d), c, k, p, D(v), D(w), f, D(v) * 2) for d, c, k, p, v, w, f in rows]
    cities = spark.createDataFrame([("c1", "A", "A - XX", "S1", "XX", "R1"), ("c2", "B", "B - YY", "S2", "YY", "R1")], "city_id string, city_name string, city_uf string, state_name string, uf string, region string")
    countries = spark.createDataFrame([("k1", "K1"), ("k2", "K2"), ("k3", "K3")], "country_id string, country_name string")
    products = spark.createDataFrame([("p1", "P1"), ("p2", "P2")], "product_category_id string, product_category_name string")
    return Star(spark.createDataFrame(data, FACT), cities, countries, products)


@pytest.fixture(scope="module")
def star(spark):
    return make(
        spark,
        [
            ("2023-02-01", "c1", "k1", "p1", "4", "2", "exp"),
            ("2023-05-01", "c2", "k2", "p2", "10", "5", "imp"),
            ("2024-02-01", "c1", "k1", "p1", "6", "2", "exp"),
            ("2024-02-01", "N/A", "k3", "p2", "3", "1", "imp"),
            ("2024-04-01", "c2", "k2", "p1", "2", "1", "exp"),
        ],
    )


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_sums_and_blanks(star):
    got = {r[0]: r[1:] for r in rows(M.evaluate(star, ["exports", "imports", "flow", "balance"], ["trade_date"]))}
    assert got[dt.date(2023, 5, 1)] == (None, D("10.00"), D("10.00"), D("-10.00"))
    assert got[dt.date(2024, 2, 1)] == (D("6.00"), D("3.00"), D("9.00"), D("3.00"))


def test_price_is_ratio_of_sums(star):
    assert M.evaluate(star, ["export_price"], []).first()[0] == pytest.approx(12 / 5)


def test_unknown_member_stays(star):
    got = dict(rows(M.evaluate(star, ["imports"], ["state_name"])))
    assert got[None] == D("3.00")


def test_flag_slicer_is_replaced_but_counts_for_plain_totals(star):
    ctx = FilterContext().where(trade_flag=["imp"])
    assert M.evaluate(star, ["exports"], [], ctx).first()[0] == D("12.00")
    assert M.evaluate(star, ["total_value"], [], ctx).first()[0] == D("13.00")


def test_share_ignores_slicers_in_its_total(star):
    ctx = FilterContext().where(year=[2024])
    got = {r.country_name: r.share for r in M.share_of_all(star, "exports", ["country_name"], ctx).collect()}
    assert got["K1"] == pytest.approx(6 / 12) and got["K2"] == pytest.approx(2 / 12)


def test_share_over_members(star):
    got = {(r.year, r.country_name): r.share for r in M.share_over(star, "country_name", ["year"], FilterContext().where(country_name=["K1"])).collect()}
    assert got == {(2023, "K1"): pytest.approx(4 / 14), (2024, "K1"): pytest.approx(6 / 11)}


def test_share_over_keeps_the_unknown_group(star):
    got = {(r.state_name, r.country_name): r.share for r in M.share_over(star, "country_name", ["state_name"]).collect()}
    assert got[(None, "K3")] == 1.0


def test_top_n_choices(spark):
    assert [r.n for r in R.top_n_choices(spark).collect()] == list(range(1, 21))


def test_filter_context(star):
    ctx = FilterContext().where(region=["R1"]).within(region=["R1", "R9"])
    assert ctx.members == {"region": ("R1",)}
    assert M.evaluate(star, ["imports"], [], ctx).first()[0] == D("10.00")
    assert ctx.without("region").empty
    low = FilterContext(date_from=dt.date(2024, 1, 1), date_to=dt.date(2024, 3, 1)).without_lower_date()
    assert (low.date_from, low.date_to) == (None, dt.date(2024, 3, 1))


def test_key_slicer_does_not_split_groups(star):
    ctx = FilterContext().where(trade_country_id=["k1", "k2"], city_id=["c1", "c2"])
    assert rows(M.evaluate(star, ["exports"], ["year"], ctx)) == [(2023, D("4.00")), (2024, D("8.00"))]


def test_bridge_gives_the_same_groups(spark, star):
    lines = star.fact().withColumnRenamed("trade_country_id", "seller")
    bridge = spark.createDataFrame([("k1", "k1"), ("k2", "k2"), ("k3", "k3")], "seller string, trade_country_id string")

    def provider(keys, lo, hi):
        return lines if "seller" in keys else lines.join(bridge, "seller", "left")

    bridged = Star(provider, *star.dims.values(), bridges={"trade_country_id": Bridge("seller", bridge)})
    for by in (["country_name"], ["trade_country_id", "year"], ["year", "country_name"], ["city_uf", "country_name"]):
        for ctx in (FilterContext(), FilterContext().where(trade_country_id=["k1", "k3"]), FilterContext().where(country_name=["K2"])):
            assert rows(M.evaluate(bridged, ["total_value"], by, ctx)) == rows(M.evaluate(star, ["total_value"], by, ctx))


def test_distinct_members(star):
    got = {r.trade_date: (r.exports_members, r.imports_members) for r in M.members_by_flag(star, "trade_country_id", ["trade_date"]).collect()}
    assert got[dt.date(2024, 2, 1)] == (1, 1)
    exact = rows(M.members_by_flag(star, "city_id", ["year"]))
    assert rows(sketches.estimated_members(sketches.member_sketches(star, "city_id", []), ["year"])) == exact


def test_last_year(star):
    got = {r.trade_date: r for r in timeintel.with_last_year(star, ["exports"], ["trade_date"]).collect()}
    assert got[dt.date(2024, 2, 1)].exports_ly == D("4.00")
    assert got[dt.date(2024, 4, 1)].exports_ly is None
    assert got[dt.date(2024, 5, 1)].exports is None  # only a year-ago import
    yoy = {r.year: r.exports_yoy for r in R.year_over_year(star, ["year"]).collect()}
    assert yoy == {2023: None, 2024: pytest.approx(1.0)}


def test_last_year_reads_behind_the_slicer(star):
    ctx = FilterContext(date_from=dt.date(2024, 1, 1), date_to=dt.date(2024, 12, 1))
    got = timeintel.with_last_year(star, ["exports"], ["year"], ctx).collect()
    assert [(r.year, r.exports, r.exports_ly) for r in got] == [(2024, D("8.00"), D("4.00"))]


def test_running_total_fills_gaps_and_ignores_lower_bound(star):
    all_months = {r.trade_date: r.exports_acc for r in timeintel.running_total(star, ["exports"], ["trade_date"]).collect()}
    assert all_months[dt.date(2023, 2, 1)] == all_months[dt.date(2024, 1, 1)] == D("4.00")
    assert all_months[dt.date(2024, 3, 1)] == D("10.00") and all_months[dt.date(2024, 12, 1)] == D("12.00")
    ctx = FilterContext().where(year=[2024])
    assert rows(timeintel.running_total(star, ["exports"], ["year"], ctx)) == [(2024, D("12.00"))]


def test_running_total_per_member_with_missing_year(spark):
    star = make(spark, [("2021-01-01", "c1", "k1", "p1", "5", "1", "exp"), ("2023-01-01", "c1", "k1", "p1", "1", "1", "exp"), ("2023-01-01", "c1", "k2", "p1", "7", "1", "exp")])
    got = rows(timeintel.running_total(star, ["exports"], ["country_name", "year"]))
    assert got == [("K1", 2021, D("5.00")), ("K1", 2022, D("5.00")), ("K1", 2023, D("6.00")), ("K2", 2023, D("7.00"))]


def test_span(star):
    assert tuple(timeintel.span_of(star, "imports").first()) == (dt.date(2023, 5, 1), dt.date(2024, 2, 1))


@pytest.mark.parametrize("names, expected", [("ABB", ("B", 2)), ("AAA", ("A", 3)), ("ABA", ("A", 1))])
def test_lead_streak(spark, names, expected):
    leaders = spark.createDataFrame([(2020 + i, n) for i, n in enumerate(names)], "year int, name string")
    assert tuple(timeintel.lead_streak(leaders, "year", "name").first()) == expected


def groups(spark, values):
    return spark.createDataFrame([(f"m{i}", None if v is None else D(v)) for i, v in enumerate(values)], "m string, v decimal(20,2)")


def test_top_n_keeps_ties(spark):
    assert {r.m for r in ranking.top_n(groups(spark, [9, 7, 7, 1, None]), "v", 2).collect()} == {"m0", "m1", "m2"}
    assert {r.m for r in ranking.top_n(groups(spark, [9, 7, 1, None]), "v", 1, ascending=True).collect()} == {"m2"}
    assert ranking.top_n(groups(spark, [None]), "v", 3).count() == 0


def test_top_n_and_others_add_up(spark):
    g = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2), (None, 0.0)], "m string, v double")
    assert dict(rows(ranking.top_n_others(g, "m", "v", 1))) == {"a": 0.5, "Outros": pytest.approx(0.5)}
    squares = g.withColumn("v", F.col("v") * F.col("v"))
    assert dict(rows(ranking.top_n_others(squares, "m", "v", 1))) == {"a": 0.25, "Outros": pytest.approx(0.13)}


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_dense_rank_equals_window(spark, slices):
    values = [5, 5, 5, 1, 9, 3, 3, None, 9, -2] + list(range(20, 60))
    got = {r.m: r.ranking for r in ranking.dense_rank_of(groups(spark, values), "v", slices=slices).collect()}
    order = sorted({v for v in values if v is not None}, reverse=True)
    assert got == {f"m{i}": len(order) + 1 if v is None else order.index(v) + 1 for i, v in enumerate(values)}


def test_leaders_join_tied_names(spark):
    assert tuple(ranking.leaders(groups(spark, [2, 7, 7]), "m", "v").first()) == ("m1m2", D("7.00"))
    assert tuple(ranking.first_member(groups(spark, [2, 7, 7]), "m", "v").first()) == ("m1", D("7.00"))


def test_hhi(spark):
    two = make(spark, [("2024-01-01", "c1", "k1", "p1", "5", "1", "exp"), ("2024-01-01", "c1", "k2", "p1", "5", "1", "imp"), ("2025-01-01", "c1", "k2", "p1", "5", "1", "exp")])
    assert rows(concentration.hhi(two, "country_name", ["year"])) == [(2024, 0.5), (2025, 1.0)]
    assert [r.band for r in R.concentration_by_year(two).collect()] == ["high", "high"]


def test_cube_levels_add_up(star):
    got = R.totals(star, ["total_value"], ["year", "region"]).collect()
    by_level = {}
    for r in got:
        by_level[r.level] = by_level.get(r.level, 0) + r.total_value
    assert set(by_level) == {0, 1, 2, 3} and len(set(by_level.values())) == 1


def test_top_members_ranks_without_own_slicer(star):
    ctx = FilterContext().where(country_name=["K2"])
    assert rows(R.top_members(star, "exports", "country_name", 1, ctx)) == []
    assert rows(R.top_members(star, "exports", "country_name", 2, ctx)) == [("K2", D("2.00"))]


def test_measure_picker(star):
    wide = M.evaluate(star, ["exports", "imports"], ["year"])
    assert {r.measure for r in M.measure_picker(wide, ["year"], ["exports", "imports"], ["imports"]).collect()} == {"imports"}


def test_unknown_measure(star):
    with pytest.raises(KeyError):
        M.evaluate(star, ["profit"], [])
