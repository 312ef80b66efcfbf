"""Versions, ledgers, schemas, rollups, sketches, table filters, one-read tests, and what is kept apart."""

import datetime as dt
import re
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quayside.operators import cleansing, quality
from quayside.operators.incremental import DuplicateKeys, require_unique
from quayside.plans import build, rollup, silver, sketches, table_bronze
from quayside.plans import measures as M
from quayside.plans.star import FilterContext, Star
from quayside.plans.table_star import SCHEMAS as table_star_schemas
from quayside.plans.table_star import table_star
from quayside.sources import partitioned, responses

from test_pipeline import T1, T2, T3, bronze, cities, countries, raw  # isort: skip


def rows(spark, *items, schema="k int, p string, v int"):
    return spark.createDataFrame(list(items), schema)


def content(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- versions


def test_nothing_is_seen_before_the_commit(spark, tmp_path):
    root = str(tmp_path)
    assert partitioned.version(spark, root) is None and partitioned.mark(spark, root) is None
    with pytest.raises(FileNotFoundError):
        partitioned.read(spark, root)
    partitioned.upsert(spark, root, rows(spark, (1, "a", 1), (2, "b", 2)), ["k", "p"], "p")
    before = partitioned.version(spark, root)
    lost = partitioned.stage(spark, root, rows(spark, (1, "a", 9), (3, "c", 3)), ["k", "p"], "p", before)
    assert content(partitioned.read(spark, root)) == [(1, "a", 1), (2, "b", 2)]
    partitioned.upsert(spark, root, rows(spark, (1, "a", 9), (3, "c", 3)), ["k", "p"], "p")
    assert content(partitioned.read(spark, root)) == [(1, "a", 9), (2, "b", 2), (3, "c", 3)]
    assert content(partitioned.read(spark, root, before)) == [(1, "a", 1), (2, "b", 2)]
    with pytest.raises(partitioned.Conflict):
        partitioned.commit(spark, root, lost)
    assert partitioned.versions(spark, root) == [1, 2]


def test_a_second_writer_begins_again(spark, tmp_path, monkeypatch):
    """Between a writer's stage and its commit another one commits: both loads are in the table."""
    root, key = str(tmp_path), ["k", "p"]
    partitioned.upsert(spark, root, rows(spark, (1, "a", 1)), key, "p")
    real, other = partitioned.stage, []

    def interrupted(*args, **kw):
        staged = real(*args, **kw)
        if not other:
            other.append(True)
            partitioned.commit(spark, root, real(spark, root, rows(spark, (2, "a", 2)), key, "p", partitioned.version(spark, root)))
        return staged

    monkeypatch.setattr(partitioned, "stage", interrupted)
    partitioned.upsert(spark, root, rows(spark, (3, "a", 3)), key, "p")
    assert content(partitioned.read(spark, root)) == [(1, "a", 1), (2, "a", 2), (3, "a", 3)]


def test_odd_partition_values_and_their_mark(spark, tmp_path):
    root = str(tmp_path)
    values = ["a/b=c", "ü 1", "0301", None, "10%"]
    partitioned.upsert(spark, root, rows(spark, *[(i, v, i) for i, v in enumerate(values)]), ["k", "p"], "p")
    partitioned.upsert(spark, root, rows(spark, (0, "a/b=c", 10), (5, None, 5)), ["k", "p"], "p")
    assert content(partitioned.read(spark, root)) == content(rows(spark, (0, "a/b=c", 10), (1, "ü 1", 1), (2, "0301", 2), (3, None, 3), (4, "10%", 4), (5, None, 5)))
    assert partitioned.mark(spark, root) == "ü 1"


def test_mark_of_dates_reads_no_file(spark, tmp_path):
    root = str(tmp_path)
    days = [(1, dt.date(2024, 1, 1), 1), (2, dt.date(2023, 12, 1), 2)]
    partitioned.upsert(spark, root, rows(spark, *days, schema="k int, p date, v int"), ["k", "p"], "p")
    for f in tmp_path.rglob("*.parquet"):
        f.write_bytes(b"")  # were a file opened, this would fail
    assert partitioned.mark(spark, root) == dt.date(2024, 1, 1)


def test_schema_grows_and_refuses(spark, tmp_path):
    root, key = str(tmp_path), ["k", "p"]
    partitioned.upsert(spark, root, rows(spark, (1, "a", 1)), key, "p")
    partitioned.upsert(spark, root, rows(spark, (2, "a", 2**40, "x"), schema="k int, p string, v bigint, note string"), key, "p")
    partitioned.upsert(spark, root, rows(spark, (3, "b"), schema="k int, p string"), key, "p")
    assert content(partitioned.read(spark, root)) == [(1, "a", 1, None), (2, "a", 2**40, "x"), (3, "b", None, None)]
    with pytest.raises(partitioned.SchemaChange, match="column v: string does not fit bigint"):
        partitioned.upsert(spark, root, rows(spark, (4, "a", "x"), schema="k int, p string, v string"), key, "p")
    assert len(partitioned.versions(spark, root)) == 3


def test_replace_and_empty_loads(spark, tmp_path):
    root, key = str(tmp_path), ["k", "p"]
    none = rows(spark)
    partitioned.upsert(spark, root, none, key, "p")
    assert content(partitioned.read(spark, root)) == []
    partitioned.upsert(spark, root, rows(spark, (1, "a", 1), (2, "b", 2)), key, "p")
    partitioned.upsert(spark, root, none, key, "p")
    assert partitioned.versions(spark, root) == [1, 2]
    partitioned.upsert(spark, root, rows(spark, (3, "c", 3)), key, "p", replace=True)
    assert content(partitioned.read(spark, root)) == [(3, "c", 3)]
    with pytest.raises(DuplicateKeys):
        partitioned.upsert(spark, root, rows(spark, (3, "c", 3), (3, "c", 4)), key, "p")


MANIFEST = "path string, n int"


def test_files_are_loaded_once(spark, tmp_path):
    root = str(tmp_path / "t")
    files = {"f1": [(1, "a", 1, 1)], "f2": [(1, "a", 2, 2), (2, "b", 1, 1)], "empty": []}
    landed = spark.createDataFrame([(p, len(r)) for p, r in files.items()], MANIFEST)
    asked = []

    def contents(paths):
        asked.append(sorted(paths))
        return spark.createDataFrame([r for p in paths for r in files[p]], "k int, p string, v int, loaded_at int")

    def load(some):
        return partitioned.load_files(spark, root, some, contents, MANIFEST, ["k", "p"], "p", "loaded_at")

    assert load(landed.filter("path = 'f1'")) == 1
    assert load(landed) == 2 and load(landed) == 0
    assert asked == [["f1"], ["empty", "f2"]]
    assert content(partitioned.read(spark, root).select("k", "p", "v")) == [(1, "a", 2), (2, "b", 1)]
    assert content(partitioned.ledger(spark, root, MANIFEST)) == [("empty", 0), ("f1", 1), ("f2", 2)]


def test_parallel_load_finds_the_first_ones_files(spark, tmp_path, monkeypatch):
    root, real, nested = str(tmp_path / "t"), partitioned.stage, []
    landed = spark.createDataFrame([("f1", 1)], MANIFEST)

    def load():
        return partitioned.load_files(spark, root, landed, lambda _: spark.createDataFrame([(1, "a", 1)], "k int, p string, loaded_at int"), MANIFEST, ["k", "p"], "p", "loaded_at")

    def interrupted(*args, **kw):
        staged = real(*args, **kw)
        if not nested:
            nested.append(None)
            nested.append(load())
        return staged

    monkeypatch.setattr(partitioned, "stage", interrupted)
    assert load() == 0 and nested[1] == 1
    assert partitioned.ledger(spark, root, MANIFEST).count() == 1


# --- unknown members, widths


def test_unknown_members_are_summed_and_reported(spark):
    some = raw(
        spark, ("Nowhere", "2024", "01", "China", "0301", "10", "1", T1), ("Elsewhere", "2024", "01", "China", "0301", "5", "2", T2),
        (None, "2024", "01", "China", "0301", "1", "1", T1), ("Belém - PA", "2024", "01", "China", "0301", "7", "1", T1),
        ("Lost", "2024", "01", "Atlantis", "0301", "3", "1", T1),
    )
    args = (cities(spark), countries(spark), "exp", T3)
    got = {(r.city_id, r.trade_country_id): (r.fob_value, r.net_weight, r.loaded_at) for r in silver.silver_trades(some, *args, unknown="sum").collect()}
    assert got == {("N/A", "160"): (D(16), D(4), T2), ("1501402", "160"): (D(7), D(1), T1), ("N/A", "N/A"): (D(3), D(1), T1)}
    assert silver.silver_trades(some, *args).count() == 5
    assert tuple(silver.unknown_report(silver.resolved_trades(some, *args)).first()) == ("exp", 1, 3, D(16), D(4))


def test_same_record_twice_is_not_summed(spark):
    schema = "key string, member string, name string, v int"
    twice = spark.createDataFrame([("k", "N/A", "x", 1), ("k", "N/A", "x", 2), ("k", "N/A", "y", 4), ("j", "1", "x", 1), ("j", "1", "X", 1)], schema)
    got = cleansing.sum_unknown(twice, ["key", "member"], ["name"], {"member": "N/A"}, ["v"])
    assert content(got.select("key", "v", "records")) == [("j", 1, 1), ("j", 1, 1), ("k", 2, 1), ("k", 5, 2)]


def test_run_with_two_unmatched_cities(spark, tmp_path):
    some = raw(spark, ("Nowhere", "2024", "01", "China", "0301", "10", "1", T1), ("Elsewhere", "2024", "01", "China", "0301", "1", "1", T1))
    star = build.run(spark, str(tmp_path), bronze(spark, some, some), T2, unknown_member=True, unknown="sum")
    assert tuple(M.evaluate(star, ["exports", "imports"], []).first()) == (D(11), D(11))


def test_run_keeps_its_manifest(spark, tmp_path):
    e = raw(spark, ("Belém - PA", "2024", "01", "China", "0301", "10", "1", T1))
    once = replace(bronze(spark, e, e), manifests={"exports": spark.createDataFrame([("f1", 1)], MANIFEST)})
    build.run(spark, str(tmp_path), once, T2)
    assert content(partitioned.ledger(spark, f"{tmp_path}/silver/exports", MANIFEST)) == [("f1", 1)]


def test_rows_without_a_name_are_no_hot_key(spark):
    some = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("Belem - PA")).alias("city"))
    found = cleansing.resolve_name(some, "city", cities(spark), "text", "id", "_city")
    assert found.filter("_city IS NULL").count() == 1000 and found.count() == 3000


def test_values_that_would_be_cut(spark):
    seed = spark.createDataFrame([("STANDARD X", "a"), ("STANDARD Y", "a"), ("LARG  ", None), (None, "abcdef")], "id string, name string")
    got = quality.cut_values(seed, "seed", {"id": 4, "name": 5})
    assert content(got) == [("seed", "id", "STANDARD X", 10, "STAN", 1), ("seed", "id", "STANDARD Y", 10, "STAN", 1), ("seed", "name", "abcdef", 6, "abcde", 1)]
    with pytest.raises(quality.QualityError, match="seed.id width: 2"):
        quality.gate(quality.widths_fit(seed, "seed", {"id": 4}))
    quality.gate(quality.widths_fit(seed, "seed", {"id": 10, "name": 6}))


def test_widths_keep_whole_ids(spark):
    some = raw(spark, ("Belém - PA", "2024", "01", "China", "STANDARD X", "10", "1", T1), ("Belém - PA", "2024", "01", "China", "STANDARD Y", "4", "1", T1))
    wide = silver.silver_trades(some, cities(spark), countries(spark), "exp", T3, widths=silver.Widths(heading=25))
    assert {r.product_category_id for r in wide.collect()} == {"STANDARD X", "STANDARD Y"}


# --- data tests from one read


def _scans(frame) -> int:
    return len(re.findall(r"Scan parquet", frame._jdf.queryExecution().executedPlan().toString()))


def test_suite_equals_single_tests_and_reads_once(spark, tmp_path):
    items = [(1, "a", "x"), (1, "a", None), (2, None, "x"), (2, None, "y"), (None, "b", "lost"), (3, "c", "lost"), (4, "d", "y")]
    spark.createDataFrame(items, "k int, j string, fk string").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    parent = spark.createDataFrame([("x",), ("y",)], "pk string")
    single = quality.report(
        quality.not_null(frame, "t", ["k", "j", "fk"]), quality.unique(frame, "t", ["k", "j"]),
        quality.relationships(frame, "t", "fk", parent, "pk"), quality.relationships(frame, "t", "j", parent, "pk"),
    )
    once = quality.suite(frame, "t", ["k", "j", "fk"], ["k", "j"], {"fk": (parent, "pk"), "j": (parent, "pk")})
    assert _scans(once) == 2  # fk is no part of the key
    assert content(once) == content(single)
    whole = quality.suite(frame, "t", ["k", "j", "fk"], ["k", "j", "fk"], {"fk": (parent, "pk"), "j": (parent, "pk")})
    assert _scans(whole) == 1
    assert {tuple(r) for r in whole.collect()} - {tuple(r) for r in single.collect()} == {("t", "unique", "k, j, fk", 0)}
    assert content(quality.suite(frame.limit(0), "t", ["k"], ["k"], {"fk": (parent, "pk")})) == [("t", "not_null", "k", 0), ("t", "relationships", "fk", 0), ("t", "unique", "k", 0)]
    assert content(quality.suite(frame, "t", ["j"])) == [("t", "not_null", "j", 2)]


# --- filters that are tables


def test_table_filter_replaces_or_keeps(spark, sf):
    star = table_star(spark, sf)
    asia = spark.createDataFrame([("ASIA",), ("EUROPE",)], "region string")
    by = lambda ctx: {r.region: r.exports for r in M.evaluate(star, ["exports"], ["region"], ctx).collect()}
    every = by(FilterContext())
    assert by(FilterContext().where(region=["EUROPE", "AFRICA"]).matching(asia)) == {r: every[r] for r in ("ASIA", "EUROPE")}
    assert by(FilterContext().where(region=["EUROPE", "AFRICA"]).matching(asia, keep=True)) == {"EUROPE": every["EUROPE"]}
    assert by(FilterContext().matching(asia).matching(spark.createDataFrame([("ASIA",)], "region string"))) == {"ASIA": every["ASIA"]}
    assert not FilterContext().matching(asia).empty and FilterContext().matching(spark.createDataFrame([(1997,)], "year int")).without_dates().empty


def test_table_filter_over_two_dimensions_and_a_period(spark, sf):
    star = table_star(spark, sf)
    fine = M.evaluate(star, ["exports"], ["region", "country_name", "year"])
    pairs = fine.filter("exports IS NOT NULL").orderBy("region", "country_name", "year").limit(7)
    got = M.evaluate(star, ["exports"], [], FilterContext().matching(pairs.select("region", "country_name", "year"))).first()[0]
    assert got == pairs.agg(F.sum("exports")).first()[0]
    plan = M.evaluate(star, ["exports"], ["year"], FilterContext().matching(pairs.select("region", "year")))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


# --- rollups and sketches


FACT = "trade_date date, city_id string, trade_country_id string, product_category_id string, trade_flag string, fob_value decimal(20,2), fob_value_real decimal(38,4), net_weight decimal(20,2)"


def test_rollup_follows_the_fact_and_stands_in_for_it(spark, tmp_path):
    fact, root = str(tmp_path / "fact"), str(tmp_path / "rollup")
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    row = lambda d, city, fob: (d, city, "160", "0301", "exp", D(fob), D(fob), D(1))
    key = list(silver.FACT_KEY)
    assert rollup.refresh(spark, fact, root) == 0
    partitioned.upsert(spark, fact, spark.createDataFrame([row(jan, "1", 10), row(jan, "2", 5), row(feb, "1", 3)], FACT), key, "trade_date")
    assert rollup.refresh(spark, fact, root) == 2 and rollup.refresh(spark, fact, root) == 0
    partitioned.upsert(spark, fact, spark.createDataFrame([row(feb, "1", 4), row(mar, "9", 1)], FACT), key, "trade_date")
    assert rollup.refresh(spark, fact, root) == 2
    rolled = partitioned.read(spark, root)
    assert content(rolled) == content(rollup.summed(partitioned.read(spark, fact)).select(*rolled.columns))
    partitioned.upsert(spark, fact, spark.createDataFrame([row(mar, "9", 2)], FACT), key, "trade_date", replace=True)
    rollup.refresh(spark, fact, root)
    assert [r.fob_value for r in partitioned.read(spark, root).collect()] == [D(2)]


def test_page_query_scans_no_fact(spark, tmp_path, sf):
    plain = table_star(spark, sf)
    rolled = plain.fact({"trade_country_id", "product_category_id", "fob_value_real"}).groupBy(*rollup.KEYS).agg(*[F.sum(c).cast(t).alias(c) for c, t in rollup.SUMS.items()])
    rolled.write.parquet(str(tmp_path / "r"))
    star = Star(plain.fact, plain.dims["city"], plain.dims["country"], plain.dims["product"], rollup=spark.read.parquet(str(tmp_path / "r")))
    short = M.evaluate(star, ["exports", "balance_real"], ["year", "country_name"])
    assert "l_shipdate" not in short._jdf.queryExecution().optimizedPlan().toString()
    assert content(short) == content(M.evaluate(plain, ["exports", "balance_real"], ["year", "country_name"]))
    by_city = M.evaluate(star, ["exports"], ["region"])  # needs a key that the rollup has not
    assert "l_shipdate" in by_city._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_keep_their_bound(spark):
    many = spark.range(60_000).select(
        F.expr("date_add(date'2024-01-01', cast(id % 3 as int) * 31)").alias("trade_date"), (F.col("id") % 20_000).cast("string").alias("city_id"), F.lit("exp").alias("trade_flag"),
    )
    empty = spark.createDataFrame([], "city_id string, region string")
    star = Star(many, empty, empty, empty)
    kept = sketches.member_sketches(star, "city_id", [], 12)
    got = sketches.with_bound(M.members_by_flag(star, "city_id", ["year"]), sketches.estimated_members(kept, ["year"]), ["year"], 12).first()
    assert got.exports_members == 20_000 and got.exports_within and got.imports_estimate == 0 and got.imports_within
    assert abs(got.exports_estimate - 20_000) > 0
    with pytest.raises(KeyError):
        sketches.estimated_members(kept, ["region"])


# --- kept apart


def test_pages_are_judged(spark):
    record = "a: string"
    pages = {'{"data":[{"a":"1"}]}': None, '{"data":{"list":[{"a":"1"}]}}': None, '{"data":[]}': None, "{": "not JSON", "": "empty", " ": "empty", None: "empty", '{"data":{}}': "no record list", '{"x":1}': "no record list"}
    frame = spark.createDataFrame([(p,) for p in pages], "value string")
    assert {r.value: r.reason for r in responses.judged(frame, responses.trade_fault(F.col("value"), record)).collect()} == pages
    good = '{"status":"REQUEST_SUCCEEDED","Results":{"series":[{"data":[{"a":"1"}]}]}}'
    index = {good: None, good.replace("SUCCEEDED", "REFUSED"): "status REQUEST_REFUSED", "{}": "status missing", '{"status":"REQUEST_SUCCEEDED"}': "no record list", "x": "not JSON"}
    frame = spark.createDataFrame([(p,) for p in index], "value string")
    assert {r.value: r.reason for r in responses.judged(frame, responses.index_fault(F.col("value"), record)).collect()} == index


def test_unreadable_values(spark):
    frame = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-01"), ("1", "2024-13-01"), ("y", "z"), (None, None)], "n string, d string")
    got = responses.unreadable(frame, {"n": "decimal(20,2)", "d": "date"}).select("column_name", "value", "type")
    assert content(got) == [("d", "2024-13-01", "date"), ("n", "x", "decimal(20,2)"), ("n", "y", "decimal(20,2)")]


def test_small_loads_do_not_rewrite_the_table_each_time(spark, tmp_path):
    """Twenty loads into the same two partitions, the newest copies first: each row is written a few times at most."""
    root, key = str(tmp_path), ["k", "p"]
    for i in range(20):
        some = rows(spark, *[(k, p, 100 - i) for k in (0, i + 1) for p in "ab"])
        partitioned.upsert(spark, root, some, key, "p", newest="v")
    found = sorted([(k, p, 100 - max(k - 1, 0)) for k in range(21) for p in "ab"], key=repr)
    assert content(partitioned.read(spark, root)) == found
    assert spark.read.parquet(f"{root}/data").count() <= 3 * 20 * 4
    assert max(len(partitioned.version(spark, root).loads(f"p={p}")) for p in "ab") < partitioned.FAN
    # layers meet a load that replaces rows, and a load by another rule
    partitioned.upsert(spark, root, rows(spark, (0, "a", 1)), key, "p")
    assert content(partitioned.read(spark, root)) == sorted([r for r in found if r[:2] != (0, "a")] + [(0, "a", 1)], key=repr)
    partitioned.upsert(spark, root, rows(spark, (0, "b", 200, 1), schema="k int, p string, v int, w int"), key, "p", newest="w")
    both = [r for r in found if r[:2] not in {(0, "a"), (0, "b")}] + [(0, "a", 1), (0, "b", 200)]
    assert content(partitioned.read(spark, root).drop("w")) == sorted(both, key=repr)


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_known_rows_are_not_shuffled_for_the_unknown_ones(spark):
    some = spark.range(50).selectExpr("id AS key", "CASE WHEN id % 9 = 0 THEN 'N/A' ELSE 'x' END AS member", "'n' AS name", "id AS v")
    got = cleansing.sum_unknown(some.unionByName(some.filter("id < 2")), ["key", "member"], ["name"], {"member": "N/A"}, ["v"])
    assert "Exchange" not in physical(got.filter("member = 'x'"))
    assert got.filter("member = 'x'").count() == 45 and got.filter("member = 'N/A'").count() == 7


def test_gathered_rows_are_written_as_they_come(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(partitioned, "sized", lambda *_: pytest.fail("shuffled"))
    partitioned.upsert(spark, str(tmp_path), rows(spark, (1, "a", 1), (2, "b", 2)), ["k", "p"], "p", gathered=True)
    assert content(partitioned.read(spark, str(tmp_path))) == [(1, "a", 1), (2, "b", 2)]


def test_unique_keys_with_one_hash(spark):
    """A missing part leaves a hash as it is: equal hashes alone are no fault, equal keys are."""
    pairs = [("a", None), (None, "a")]
    require_unique(spark.createDataFrame(pairs, "k string, p string"), ["k", "p"])
    with pytest.raises(DuplicateKeys, match="occurs 2 times"):
        require_unique(spark.createDataFrame([*pairs, ("a", None)], "k string, p string"), ["k", "p"])


def test_nations_meet_orders_before_records_are_summed(spark, tmp_path):
    """Customers that come twice, have no nation, or are missing give the records that a join after the sums gave."""
    day = dt.datetime(1997, 3, 5)
    tables = {
        "customer": ([(1, "c", 3, 0.0, "m"), (1, "c", 4, 0.0, "m"), (2, "c", None, 0.0, "m")], table_star_schemas["customer"]),
        "supplier": ([(7, "s", 2, 0.0)], table_star_schemas["supplier"]),
        "part": ([(8, "p", "b", "TYPE", 1, 0.0)], table_star_schemas["part"]),
        "orders": ([(i, c, "O", 0.0, day, "5-LOW") for i, c in ((10, 1), (11, 1), (12, 2), (13, 3), (14, None))], table_star_schemas["orders"]),
        "lineitem": ([(i, 8, 7, 1, 2.0, 5.0, 0.0, 0.0, "N", "O", day) for i in range(10, 15)], table_star_schemas["lineitem"]),
    }
    for name, (some, schema) in tables.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    trades = table_bronze.bronze_trades(spark, str(tmp_path), "exp")
    text = physical(trades)
    assert text.index("Aggregate") < text.index("Join")
    found = [(r.noMunMinsgUf, r.state, r.metricFOB) for r in trades.collect()]
    expected = [("CIDADE AAAAAAAAB - AD", "AD", "10.00"), ("CIDADE AAAAAAAAB - AE", "AE", "10.00"), (None, None, "5.00"), (None, None, "5.00"), (None, None, None)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
