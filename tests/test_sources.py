"""Files, seeds, response pages, and the file stream."""

import json

from pyspark.sql import functions as F

from quayside.operators import cleansing
from quayside.sources import files, partitioned, responses, tables
from quayside.streaming.load import load_landed


def test_trade_pages_of_both_shapes(spark, tmp_path):
    record = {"country": "China", "metricFOB": "5"}
    for i, data in enumerate([{"list": [record, record]}, [record], {}, None]):
        (tmp_path / f"{i}.json").write_text(json.dumps({"data": data}, indent=1))
    got = responses.flatten_trade(responses.read_pages(spark, str(tmp_path)), "country string, metricFOB string")
    assert [tuple(r) for r in got.collect()] == [("China", "5")] * 3


def test_index_pages(spark):
    body = {"status": responses.SUCCEEDED, "message": [], "Results": {"series": [{"data": [{"year": 2024, "value": 1.5}]}, {"data": [{"year": 1}]}]}}
    pages = [body, {**body, "status": "REQUEST_NOT_PROCESSED"}, {**body, "Results": {"series": []}}, {**body, "Results": {}}]
    frame = spark.createDataFrame([(json.dumps(p),) for p in pages], "value string")
    rows = responses.flatten_index(frame, "year int, value double")
    assert [tuple(r) for r in cleansing.all_as_text(rows).collect()] == [("2024", "1.5")]


def test_seed_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("product_category_id;product_category_name;product_category_description\n0301;Peixes vivos;Peixes, vivos\n", encoding="utf-8")
    assert tuple(files.read_seed(spark, str(path), ";", files.PRODUCT_SEED).first()) == ("0301", "Peixes vivos", "Peixes, vivos")


def test_state_regions(spark):
    regions = files.state_regions(spark)
    assert regions.count() == 27 and regions.filter("uf = 'SP'").first().region == "Sudeste"


def test_landing_listing_and_scan(spark, tmp_path):
    frame = spark.range(3).select(F.col("id").cast("string").alias("country"))
    frame.coalesce(1).write.parquet(str(tmp_path / "w"))
    landing = tmp_path / "landing"
    landing.mkdir()
    part = next((tmp_path / "w").glob("*.parquet"))
    for name in ("t_export_202401_202403.parquet", "t_import_202401_202402.parquet"):
        (landing / name).write_bytes(part.read_bytes())
    listed = {r.flow: r.date_to.isoformat() for r in files.list_landing(spark, str(landing)).collect()}
    assert listed == {"export": "2024-03-01", "import": "2024-02-01"}
    rows = files.read_landing(spark, str(landing), "country string").withColumns(files.file_period(F.col("path")))
    assert {(r.flow, r["count"]) for r in rows.groupBy("flow").count().collect()} == {("export", 3), ("import", 3)}


def test_empty_manifest(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), files.MANIFEST).count() == 0
    row = spark.createDataFrame([("0301", "export", None, None, "p", None)], files.MANIFEST)
    for _ in range(2):
        tables.append(row, str(tmp_path / "m"))
    assert tables.read_or_empty(spark, str(tmp_path / "m"), files.MANIFEST).count() == 2


def test_stream_loads_each_file_once(spark, tmp_path):
    schema = "k int, period string, v string, loaded_at int"
    where = {n: str(tmp_path / n) for n in ("landing", "target", "progress")}

    def land(*rows):
        tables.append(spark.createDataFrame(list(rows), schema), where["landing"])
        load_landed(spark, where["landing"], schema, where["target"], where["progress"], ["k", "period"], "period", "loaded_at")
        return sorted((r.k, r.v) for r in partitioned.read(spark, where["target"]).collect())

    assert land((1, "2024-01", "a", 1), (1, "2024-01", "b", 2), (2, "2024-02", "c", 1)) == [(1, "b"), (2, "c")]
    assert land((2, "2024-02", "d", 2), (3, "2024-02", "e", 1)) == [(1, "b"), (2, "d"), (3, "e")]


def test_heading_filter(spark):
    codes = spark.createDataFrame([("0301",), ("0309",), ("0401",)], "c string")
    assert [r.c for r in codes.filter(cleansing.heading_filter(F.col("c"))).collect()] == ["0301"]
