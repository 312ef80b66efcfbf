"""Cleaning rules, incremental loads, quality tests and the monthly run on small inputs."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quayside.operators import cleansing, incremental, inflation, quality
from quayside.plans import build, gold, silver
from quayside.plans import measures as M
from quayside.sources import files, partitioned, tables

RAW = "noMunMinsgUf string, year string, monthNumber string, country string, state string, headingCode string, heading string, metricFOB string, metricKG string, ingested_at timestamp_ntz, loaded_at timestamp_ntz"
T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def raw(spark, *rows):
    return spark.createDataFrame([(c, y, m, k, "XX", h, "heading", fob, kg, at, at) for c, y, m, k, h, fob, kg, at in rows], RAW)


def cities(spark):
    return spark.createDataFrame(
        [("3106200", "São João - MG ", "São João", T1, T1), ("1501402", "Belém - PA", "Belém", T1, T1), ("9999999", "Longe - EX", "Longe", T1, T1)],
        "id string, text string, noMunMin string, ingested_at timestamp_ntz, loaded_at timestamp_ntz",
    )


def countries(spark):
    return spark.createDataFrame([("160", "China", T1, T1), ("249", "Estados Unidos", T1, T1)], "id string, text string, ingested_at timestamp_ntz, loaded_at timestamp_ntz")


def index(spark, *rows):
    return spark.createDataFrame([(y, p, v, T1, at) for y, p, v, at in rows], "year string, period string, value string, ingested_at timestamp_ntz, loaded_at timestamp_ntz")


def trades(spark, frame, **kw):
    return silver.silver_trades(frame, cities(spark), countries(spark), "exp", T3, **kw)


def test_names_resolve_without_accents_and_case(spark):
    r = trades(spark, raw(spark, ("SAO JOAO - mg", "2024", "3", "ESTADOS UNIDOS", "0301", "10.50", "2", T1))).first()
    assert (r.trade_date, r.city_id, r.trade_country_id, r.product_category_id) == (dt.date(2024, 3, 1), "3106200", "249", "0301")
    assert (r.fob_value, r.net_weight, r.trade_flag, r.processed_at) == (D("10.50"), D("2.00"), "exp", T3)


def test_defaults(spark):
    r = trades(spark, raw(spark, (None, None, None, None, None, "1", "1", T1))).first()
    assert tuple(r)[:4] == (dt.date(1900, 1, 1), "N/A", "N/A", "0000")


@pytest.mark.parametrize("fob, kg", [(None, "1"), ("1", None), ("0", "1"), ("-1", "1")])
def test_invalid_rows_leave(spark, fob, kg):
    assert trades(spark, raw(spark, ("Belém - PA", "2024", "1", "China", "0301", fob, kg, T1))).count() == 0


def test_newest_copy_wins_even_when_invalid(spark):
    key = ("Belém - PA", "2024", "1", "China", "0301")
    assert trades(spark, raw(spark, (*key, "1", "1", T1), (*key, "2", "1", T2))).first().fob_value == D("2.00")
    assert trades(spark, raw(spark, (*key, "1", "1", T1), (*key, "0", "1", T2))).count() == 0


def test_two_cities_of_one_normalized_name_double_the_rows(spark):
    twins = cities(spark).unionByName(cities(spark).filter("id = '1501402'").withColumns({"id": F.lit("77"), "text": F.lit("BELEM - pa")}))
    rows = raw(spark, ("Belém - PA", "2024", "1", "China", "0301", "1", "1", T1))
    assert silver.silver_trades(rows, twins, countries(spark), "exp", T3).count() == 2
    assert [tuple(r) for r in cleansing.ambiguous_names(twins, "text", "id").collect()] == [("belempa", 2)]


def test_silver_cities(spark):
    states = spark.createDataFrame([("31", "Minas Gerais", "MG"), ("15", "Pará", "PA")], "id string, text string, uf string")
    again = cities(spark).filter("id = '1501402'").withColumns({"noMunMin": F.lit("Belém Nova"), "loaded_at": F.lit(T2)})
    got = {r.city_id: r for r in silver.silver_cities(cities(spark).unionByName(again), states, files.state_regions(spark), T3).collect()}
    assert (got["3106200"].uf, got["3106200"].state_name, got["3106200"].region) == ("MG", "Minas Gerais", "Sudeste")
    assert got["1501402"].city_name == "Belém Nova"
    assert (got["9999999"].state_name, got["9999999"].region) == (None, "Não se aplica")


def test_silver_index(spark):
    frame = index(spark, ("2024", "M3", "310.1", T1), ("2024", "M03", "1", T1), ("2024", "M13", "9", T1), ("2024", None, "9", T1), ("2024", "M04", "-", T1), ("2024", "M05", None, T1), ("2024", "M06", "1", T1), ("2024", "M06", "2", T2))
    got = sorted((r.cpi_date, r.cpi_value) for r in silver.silver_index(frame, T3).collect())
    assert got == [(dt.date(2024, 3, 1), D("1.00")), (dt.date(2024, 3, 1), D("310.10")), (dt.date(2024, 6, 1), D("2.00"))]


def cpi(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), D(v)) for d, v in rows], "cpi_date date, cpi_value decimal(20,2)")


def side(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), "c", "k", "p", D(v), D(1), f) for d, v, f in rows], "trade_date date, city_id string, trade_country_id string, product_category_id string, fob_value decimal(20,2), net_weight decimal(20,2), trade_flag string")


def test_real_value_rounds_the_ratio_first(spark):
    got = inflation.deflate(side(spark, ("2020-01-01", "10.00", "exp"), ("2020-02-01", "5", "exp")), cpi(spark, ("2020-01-01", "7.00"), ("2024-01-01", "300.00")))
    assert {r.trade_date: r.fob_value_real for r in got.collect()} == {dt.date(2020, 1, 1): D("428.6000"), dt.date(2020, 2, 1): None}


def test_latest_index_is_not_the_largest(spark):
    assert inflation.latest_index(cpi(spark, ("2020-01-01", "900"), ("2024-01-01", "300.00"))).first()[0] == D("300.00")


def test_fact_is_empty_without_any_index(spark):
    exports, imports = side(spark, ("2020-01-01", "1", "exp")), side(spark, ("2020-01-01", "2", "imp"))
    assert gold.fact_trades(imports, exports, cpi(spark).limit(0), T3).count() == 0
    assert gold.fact_trades(imports, exports, cpi(spark, ("2020-01-01", "1")), T3).count() == 2


def test_incremental_fact_takes_the_mark_month_again(spark):
    exports = side(spark, ("2020-01-01", "1", "exp"), ("2020-02-01", "1", "exp"), ("2020-03-01", "1", "exp"))
    got = gold.fact_trades(side(spark), exports, cpi(spark, ("2020-01-01", "1")), T3, target=exports.filter("trade_date <= '2020-02-01'"))
    assert sorted(r.trade_date.month for r in got.collect()) == [2, 3]


def plan(spark, mark, last, **kw):
    date = "flow string, d date"
    frame = lambda v, n: spark.createDataFrame([("export", v)] if v else [], date).withColumnRenamed("d", n)
    flows = spark.createDataFrame([("export",)], "flow string")
    return tuple(incremental.ingestion_plan(flows, frame(mark, "mark"), frame(last, "last_date"), 2006, **kw).first())[1:]


@pytest.mark.parametrize(
    "mark, kw, expected",
    [
        (dt.date(2024, 12, 1), {}, ("next", dt.date(2025, 1, 1), dt.date(2025, 2, 1))),
        (dt.date(2025, 2, 1), {}, ("skip", None, None)),
        (None, {}, ("first", dt.date(2006, 1, 1), dt.date(2025, 2, 1))),
        (None, {"final_year": 2020}, ("first", dt.date(2006, 1, 1), dt.date(2020, 12, 1))),
        (None, {"final_year": 2030}, ("first", dt.date(2006, 1, 1), dt.date(2025, 2, 1))),
    ],
)
def test_ingestion_plan(spark, mark, kw, expected):
    assert plan(spark, mark, dt.date(2025, 2, 1), **kw) == expected


def windows(spark, a, b):
    frame = spark.createDataFrame([(a, b)], "date_from date, date_to date")
    return sorted((r.window_from, r.window_to) for r in incremental.load_windows(frame).collect())


def test_load_windows(spark):
    assert windows(spark, dt.date(2006, 1, 1), dt.date(2026, 3, 1)) == [
        ("2006-01", "2010-12"), ("2011-01", "2015-12"), ("2016-01", "2020-12"), ("2021-01", "2023-12"),
        ("2024-01", "2024-12"), ("2025-01", "2025-12"), ("2026-01", "2026-03"),
    ]
    assert windows(spark, dt.date(2025, 2, 1), dt.date(2025, 4, 1)) == [("2025-01", "2025-04")]
    assert windows(spark, dt.date(2010, 5, 1), dt.date(2012, 7, 1)) == [("2010-01", "2012-07")]


@pytest.mark.parametrize("span, blocks", [((2006, 2016), [(2006, 2016)]), ((2006, 2026), [(2006, 2016), (2017, 2026)]), ((2006, 2028), [(2006, 2016), (2017, 2027), (2028, 2028)])])
def test_index_windows_lose_no_year(spark, span, blocks):
    got = incremental.index_windows(spark.createDataFrame([span], "start_year int, end_year int"))
    assert sorted((r.block_from, r.block_to) for r in got.collect()) == blocks


def test_marks(spark):
    rows = spark.createDataFrame([("e", dt.date(2024, 1, 1)), ("e", dt.date(2024, 2, 1)), ("i", dt.date(2023, 1, 1))], "f string, d date")
    assert dict((r.f, r.mark) for r in incremental.marks_by(rows, "f", "d").collect()) == {"e": dt.date(2024, 2, 1), "i": dt.date(2023, 1, 1)}
    assert incremental.newer_than(rows, rows.limit(0), "d").count() == 3
    assert incremental.newer_than(rows, rows.filter("f = 'i'"), "d").count() == 2


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def test_upsert_is_idempotent_and_grows_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    new = kv(spark, (2, "new"), (3, "new")).withColumn("extra", F.lit("x"))
    tables.upsert_version(spark, path, kv(spark, (1, "old"), (2, "old")), ["k"])
    for _ in range(2):
        tables.upsert_version(spark, path, new, ["k"])
        got = sorted(tuple(r) for r in tables.read_current(spark, path).select("k", "v", "extra").collect())
        assert got == [(1, "old", None), (2, "new", "x"), (3, "new", "x")]


def test_duplicate_source_keys_raise(spark, tmp_path):
    with pytest.raises(incremental.DuplicateKeys):
        tables.upsert_version(spark, str(tmp_path / "t"), kv(spark, (1, "a"), (1, "b")), ["k"])


def test_interrupted_version_is_not_read(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_version(spark, str(path), kv(spark, (1, "a")))
    tables.write_version(spark, str(path), kv(spark, (2, "b")))
    (path / "version=2" / "_SUCCESS").rename(path / "version=2" / "was_success")
    assert tables.read_current(spark, str(path)).first().k == 1


def test_partition_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    partitioned.upsert(spark, path, kv(spark, (1, "a"), (2, "b")), ["k", "v"], "v")
    before = partitioned.version(spark, path)
    partitioned.upsert(spark, path, kv(spark, (2, "b"), (3, "b"), (4, "c")), ["k", "v"], "v")
    after = partitioned.version(spark, path)
    assert [n for n in after.folders if after.folders[n] == before.folders.get(n)] == ["v=a"]
    assert sorted(r.k for r in partitioned.read(spark, path).collect()) == [1, 2, 3, 4]
    assert sorted(r.k for r in partitioned.read(spark, path, before).collect()) == [1, 2]
    with pytest.raises(ValueError):
        partitioned.upsert(spark, path, kv(spark, (1, "a")), ["k"], "v")


def test_insert_only_members_keep_their_name(spark):
    got = incremental.insert_new(kv(spark, (1, "a"), (2, "old")), kv(spark, (2, "renamed"), (3, "c")), "k")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "old"), (3, "c")]


def test_manifest_and_pending_files(spark):
    landed = spark.createDataFrame([("x/trade_export_200601_202603.parquet",), ("x/aux_cities.parquet",)], "path string").withColumns(files.file_period(F.col("path")))
    got = {r.path: tuple(r)[1:] for r in landed.collect()}
    assert got["x/trade_export_200601_202603.parquet"] == ("trade_export", "export", dt.date(2006, 1, 1), dt.date(2026, 3, 1))
    assert got["x/aux_cities.parquet"] == (None, None, None, None)
    manifest = incremental.manifest_rows(landed.filter("flow is not null"), ["0301", "0302"])
    assert manifest.count() == 2
    assert incremental.manifest_rows_known(landed.filter("flow is not null").select("path", "flow"), manifest).count() == 2
    assert incremental.pending(landed, manifest).count() == 1


def test_quality_tests(spark):
    frame = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (None, "b")], "k int, fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    results = quality.report(
        quality.not_null(frame, "t", ["k", "fk"]), quality.unique(frame, "t", ["k"]),
        quality.unique(frame, "t", ["k", "fk"]), quality.relationships(frame, "t", "fk", parent, "pk"),
    )
    got = {(r.test, r.column_name): r.failures for r in results.collect()}
    assert got == {("not_null", "k"): 2, ("not_null", "fk"): 1, ("unique", "k"): 1, ("unique", "k, fk"): 0, ("relationships", "fk"): 2}
    with pytest.raises(quality.QualityError, match="t.k not_null: 2"):
        quality.gate(results)
    quality.gate(results.filter("failures = 0"))


def bronze(spark, exports, imports):
    return build.Bronze(
        exports=exports, imports=imports, cities=cities(spark),
        states=spark.createDataFrame([("31", "Minas Gerais", "MG"), ("15", "Pará", "PA"), ("99", "Exterior", "EX")], "id string, text string, uf string"),
        regions=files.state_regions(spark), countries=countries(spark), index=index(spark, ("2024", "M01", "100", T1), ("2024", "M02", "110", T1)),
        products=spark.createDataFrame([("0301", "Vivos", "Peixes vivos"), ("0302", "Frescos", "Peixes frescos")], files.PRODUCT_SEED),
    )


def test_monthly_run(spark, tmp_path):
    root = str(tmp_path)
    e = ("Belém - PA", "2024", "01", "China", "0301", "10", "1", T1)
    i = ("Sao Joao - MG", "2024", "02", "China", "0302", "4", "1", T1)
    star = build.run(spark, root, bronze(spark, raw(spark, e), raw(spark, i)), T2)
    assert tuple(M.evaluate(star, ["exports", "imports", "exports_real"], []).first()) == (D("10.00"), D("4.00"), D("11.0000"))
    # a second run brings a corrected January and a new February record
    more = raw(spark, e, ("Belém - PA", "2024", "02", "China", "0301", "5", "1", T2))
    star = build.run(spark, root, bronze(spark, more, raw(spark, i)), T3)
    assert tuple(M.evaluate(star, ["exports", "imports"], []).first()) == (D("15.00"), D("4.00"))
    again = build.run(spark, root, bronze(spark, more, raw(spark, i)), T3, full_refresh=True)
    assert tuple(M.evaluate(again, ["exports", "imports"], []).first()) == (D("15.00"), D("4.00"))


def test_unmatched_city_fails_strictly_and_passes_with_unknown_member(spark, tmp_path):
    rows = raw(spark, ("Nowhere", "2024", "01", "China", "0301", "10", "1", T1)), raw(spark, ("Belém - PA", "2024", "02", "China", "0302", "4", "1", T1))
    with pytest.raises(quality.QualityError, match="city_id relationships: 1"):
        build.run(spark, str(tmp_path / "strict"), bronze(spark, *rows), T2)
    star = build.run(spark, str(tmp_path / "loose"), bronze(spark, *rows), T2, unknown_member=True)
    assert M.evaluate(star, ["exports"], []).first()[0] == D("10.00")


def test_two_unmatched_cities_collide(spark, tmp_path):
    rows = raw(spark, ("Nowhere", "2024", "01", "China", "0301", "10", "1", T1), ("Elsewhere", "2024", "01", "China", "0301", "1", "1", T1))
    with pytest.raises(incremental.DuplicateKeys):
        build.run(spark, str(tmp_path), bronze(spark, rows, rows), T2)
