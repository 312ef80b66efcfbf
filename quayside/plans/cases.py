"""Named queries for whole runs, late files, growing tables, slicers and seeds, over the order tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import calendar, quality, ranking
from quayside.operators.cleansing import latest_per_key
from quayside.plans import build, gold, pipeline
from quayside.plans import measures as M
from quayside.plans import reports as R
from quayside.plans import table_bronze as B
from quayside.plans.star import FilterContext, Star
from quayside.plans.table_star import read, table_star
from quayside.session import scratch_path
from quayside.sources import files, partitioned, tables
from quayside.streaming.load import load_landed

Query = Callable[[SparkSession, str], DataFrame]


def fact_partition_growth(spark: SparkSession, sf: str) -> DataFrame:
    """A table by text partitions with leading zeros: a column comes with a second load, and stays after a third without it."""
    path = scratch_path(spark, "growth")
    orders = read(spark, sf, "orders")
    rows = orders.select(
        "o_orderkey", F.lpad((F.col("o_custkey") % 7).cast("string"), 4, "0").alias("part"), F.col("o_totalprice").cast("decimal(20,2)").alias("value")
    )
    key = ["o_orderkey", "part"]
    partitioned.upsert(spark, path, rows, key, "part")
    partitioned.upsert(spark, path, rows.filter("o_orderkey % 3 = 0").withColumn("note", F.lit("x")), key, "part")
    raised = rows.filter("o_orderkey % 3 = 1 AND part < '0004'").withColumn("value", (F.col("value") + 1).cast("decimal(20,2)"))
    partitioned.upsert(spark, path, raised, key, "part")
    return partitioned.read(spark, path).select("o_orderkey", "part", "value", "note")


def streamed_load_late(spark: SparkSession, sf: str) -> DataFrame:
    """The corrected copies land first and the older ones last, in batches of one file; the newest stay."""
    base = scratch_path(spark, "late")
    landed = tables.stored(pipeline.landed_records(spark, sf), "records")  # both landings read them
    for stamp in (B.SECOND_LOAD, B.FIRST_LOAD):
        tables.append(landed.filter(F.col("loaded_at") == F.lit(stamp).cast("timestamp_ntz")), f"{base}/landing")
    load_landed(
        spark, f"{base}/landing", landed.schema, f"{base}/target", f"{base}/progress",
        ["record", "period"], "period", "loaded_at", ("metricFOB", "metricKG"), files_per_batch=1,
    )
    return partitioned.read(spark, f"{base}/target")


def price_share_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """A ratio's share of the ratio over everything."""
    shares = M.share_of_all(table_star(spark, sf), "export_price", ["year"])
    return shares.select("year", F.round("export_price", 6).alias("export_price"), F.round("share", 6).alias("share"))


def top_n_with_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth country is missing from its dimension: the unknown member takes no place and goes to the others."""
    star = table_star(spark, sf)
    known = star.dims["country"].filter(F.col("country_id").cast("int") % 5 != 0)
    groups = M.evaluate(Star(star.fact, star.dims["city"], known, star.dims["product"]), ["exports"], ["country_name"])
    return ranking.top_n_others(groups, "country_name", "exports", 6).withColumn("exports", F.col("exports").cast("decimal(38,2)"))


def top_by_choice(spark: SparkSession, sf: str) -> DataFrame:
    """The exports that the n best states have together, for each n that the slicer offers."""
    groups = M.evaluate(table_star(spark, sf), ["exports"], ["state_name"])
    ranks = ranking.dense_rank_of(groups.filter("exports IS NOT NULL"), "exports")
    # a member of rank r is among the n best for each offered n from r on
    last = R.top_n_choices(spark).agg(F.max("n")).scalar()
    each = ranks.withColumn("last", last).filter("ranking <= last").withColumn("n", F.explode(F.sequence("ranking", "last")))
    return each.groupBy("n").agg(F.sum("exports").cast("decimal(38,2)").alias("exports"))


def sliced_within(spark: SparkSession, sf: str) -> DataFrame:
    """Two choices on one attribute, kept both: only members in both stay."""
    ctx = FilterContext().where(region=["ASIA", "EUROPE"]).within(region=["EUROPE", "AFRICA"])
    return M.evaluate(table_star(spark, sf), ["exports"], ["year"], ctx)


def quality_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return gold.seed_tests(B.product_seed(spark, sf), B.state_regions(spark, sf))


def seed_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The product seed as a delimited file with a header, read with declared types."""
    path = scratch_path(spark, "seed")
    B.product_seed(spark, sf).write.csv(path, sep=";", header=True)
    return files.read_seed(spark, path, ";", files.PRODUCT_SEED)


def _landed(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "landed")
    for flag, flow in (("exp", "export"), ("imp", "import")):
        B.bronze_trades(spark, sf, flag).write.parquet(f"{path}/trade_{flow}_199201_200112.parquet")
    return path


def landing_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All landed files in one scan; the flow is read off each row's path."""
    rows = files.read_landing(spark, _landed(spark, sf), files.TRADE_RECORD)
    flow = F.regexp_extract("path", r"trade_(\w+?)_\d+_\d+\.parquet", 1).alias("flow")
    return rows.groupBy(flow).agg(F.count("*").alias("records"), F.count_if(F.col("country").isNotNull()).alias("with_country"))


def landing_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The landed files, each a folder written in parts, from their names alone."""
    return files.list_landing(spark, _landed(spark, sf)).withColumn("path", files.file_name(F.col("path")))


def _bronze(spark: SparkSession, sf: str, unknown_category: bool = False) -> build.Bronze:
    trades = [B.bronze_trades(spark, sf, f) for f in ("exp", "imp")]
    cities, countries = (latest_per_key(x, ["id"]) for x in (B.bronze_cities(spark, sf), B.bronze_countries(spark, sf)))
    products = B.product_seed(spark, sf)
    if unknown_category:
        products = products.unionByName(spark.range(1).select(F.lit("0000").alias("product_category_id"), *[F.lit("N/A").alias(c) for c in products.columns[1:]]))
    return build.Bronze(*trades, cities, B.bronze_states(spark, sf), B.state_regions(spark, sf), countries, B.bronze_index(spark, sf), products)


def monthly_run_gate(spark: SparkSession, sf: str) -> DataFrame:
    """A run without an unknown member stops at the gold layer's gate: the failing tests, one row each."""
    root, bronze = scratch_path(spark, "gate"), _bronze(spark, sf)
    try:
        build.run(spark, root, bronze, B.RUN_AT, full_refresh=True, unknown="sum", widths=pipeline.WIDTHS)
    except quality.QualityError:
        return gold.star_tests(*build.read_gold(spark, root)).filter("failures > 0")
    raise AssertionError("the gate let unmatched names pass")


def _gold_fact(spark: SparkSession, root: str) -> DataFrame:
    return partitioned.read(spark, f"{root}/gold/fact_trades").select(*gold.FACT_COLUMNS)


def monthly_run_full(spark: SparkSession, sf: str) -> DataFrame:
    """One whole run from bronze to checked gold: silver, its tests, gold, its tests; the fact table."""
    root = scratch_path(spark, "run")
    build.run(spark, root, _bronze(spark, sf, True), B.RUN_AT, full_refresh=True, unknown_member=True, unknown="sum", widths=pipeline.WIDTHS)
    return _gold_fact(spark, root)


def monthly_run_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A first run over the months up to a cut, then an incremental one over all: the fact without its real values,
    which the first run wrote with the index known then."""
    root, bronze = scratch_path(spark, "runs"), _bronze(spark, sf, True)
    early = F.concat("year", F.lit("-"), "monthNumber") <= pipeline.CUT.strftime("%Y-%m")
    first = replace(bronze, exports=bronze.exports.filter(early), imports=bronze.imports.filter(early))
    build.run(spark, root, first, B.RUN_AT, unknown_member=True, unknown="sum", widths=pipeline.WIDTHS)
    build.run(spark, root, bronze, B.RUN_AT, unknown_member=True, unknown="sum", widths=pipeline.WIDTHS)
    return _gold_fact(spark, root).drop("fob_value_real")


def case_queries() -> dict[str, Query]:
    found = (
        fact_partition_growth, streamed_load_late, price_share_by_year, top_n_with_unmatched, top_by_choice,
        sliced_within, quality_seeds, seed_round_trip, landing_scan, landing_listing,
        monthly_run_full, monthly_run_incremental, monthly_run_gate,
    )
    english = {f"calendar_{c}": lambda s, sf, lang=lang: calendar_in(s, sf, lang) for c, lang in (("english", "en-US"), ("spanish", "es-ES"))}
    return {f.__name__: f for f in found} | english


def calendar_in(spark: SparkSession, sf: str, language: str) -> DataFrame:
    """Names of the shipping days in another language, with renamed columns and that language's labels."""
    days = calendar.calendar(calendar.bounds_of(read(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("Date")), "Date"), language)
    label = calendar.labels(spark, language).filter("label = 'quarter'").select("text").scalar()
    some = days.select("Date", "MonthName", "DayOfWeekName", "QuarterName").withColumn("quarter_label", label)
    return calendar.renamed(some, {"Date": "day", "MonthName": "month", "DayOfWeekName": "weekday", "QuarterName": "quarter"})
