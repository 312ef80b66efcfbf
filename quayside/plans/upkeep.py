"""Named queries on the upkeep of tables: versions, ledgers, rollups, sketches, kept-apart pages, filters that are tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import ranking
from quayside.operators.cleansing import latest_per_key
from quayside.operators.inflation import deflate
from quayside.plans import gold, pipeline, rollup, sketches
from quayside.plans import measures as M
from quayside.plans.star import FilterContext, Star
from quayside.plans.table_star import price_index, read, table_star
from quayside.session import scratch_path
from quayside.sources import files, partitioned, responses, tables

MANIFEST = "path string, flow string, date_from date, date_to date"


def fact_partition_pointer(spark: SparkSession, sf: str) -> DataFrame:
    """A writer is lost between two month folders, then the load is repeated: what readers see after the loss, after the
    repeat, and in the version before it."""
    path, rows = scratch_path(spark, "pointer"), tables.stored(pipeline._grain(spark, sf), "grain")
    partitioned.upsert(spark, path, rows.filter(F.col("trade_date") <= F.lit(pipeline.CUT)), gold.FACT_KEY, "trade_date")
    before = partitioned.version(spark, path)
    later = rows.filter(F.col("trade_date") >= F.lit(pipeline.CUT)).withColumn("net_weight", (F.col("net_weight") + 1).cast("decimal(20,2)"))
    partitioned.stage(spark, path, later.filter(F.month("trade_date") % 2 == 0), gold.FACT_KEY, "trade_date", before)
    states = {"lost": partitioned.read(spark, path)}
    partitioned.upsert(spark, path, later, gold.FACT_KEY, "trade_date")
    states |= {"repeated": partitioned.read(spark, path), "earlier": partitioned.read(spark, path, before)}
    seen = [F.count("*").alias("rows"), F.count_distinct("trade_date").alias("months"), F.sum("net_weight").cast("decimal(38,2)").alias("kg")]
    parts = [frame.agg(*seen).select(F.lit(name).alias("state"), "rows", "months", "kg") for name, frame in states.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def loads_after_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Files landed by year: some are loaded, a load of all is lost after its data and before its commit, then two runs
    load what waits. Per file its ledger rows, and the rows of its year in the table."""
    base = scratch_path(spark, "ledger")
    year = F.col("period").substr(1, 4)
    name = F.concat(F.lit("trade_import_"), year, F.lit("01_"), year, F.lit("12.parquet"))
    rows = pipeline.landed_records(spark, sf)
    tables.append(rows.withColumn("file", name), f"{base}/landing", ["file"])
    listed = files.list_landing(spark, f"{base}/landing")
    keys, ties = ["record", "period"], ("metricFOB", "metricKG")

    def contents(paths: list[str]) -> DataFrame:
        return spark.read.schema(rows.schema).parquet(*paths)

    def load(waiting: DataFrame) -> int:
        return partitioned.load_files(spark, f"{base}/target", waiting, contents, MANIFEST, keys, "period", "loaded_at", ties)

    load(listed.filter(F.col("date_to") < F.lit(date(1996, 1, 1))))
    every = tables.stored(latest_per_key(contents([r.path for r in listed.collect()]), keys, "loaded_at", ties), "landed")
    partitioned.stage(spark, f"{base}/target", every, keys, "period", partitioned.version(spark, f"{base}/target"), newest="loaded_at", ties=ties, manifest=listed)
    loaded, again = load(listed), load(listed)
    known = partitioned.ledger(spark, f"{base}/target", MANIFEST).groupBy(F.year("date_from").cast("string").alias("year"), "flow").agg(F.count("*").alias("ledger_rows"))
    found = partitioned.read(spark, f"{base}/target").groupBy(year.alias("year")).agg(F.count("*").alias("records"))
    return known.join(found, "year", "full").withColumns({"loaded_late": F.lit(loaded), "loaded_again": F.lit(again)})


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return deflate(pipeline._grain(spark, sf), price_index(spark, sf))


def _rolled(spark: SparkSession, sf: str) -> tuple[str, str, int]:
    """A fact loaded twice with a refresh after each; the months that the second refresh summed."""
    fact, root = scratch_path(spark, "fact"), scratch_path(spark, "rollup")
    rows = tables.stored(_fact(spark, sf), "grain")
    partitioned.upsert(spark, fact, rows.filter(F.col("trade_date") <= F.lit(pipeline.CUT)), gold.FACT_KEY, "trade_date")
    rollup.refresh(spark, fact, root)
    later = rows.filter(F.col("trade_date") >= F.lit(pipeline.CUT)).withColumn("net_weight", (F.col("net_weight") + 1).cast("decimal(20,2)"))
    partitioned.upsert(spark, fact, later, gold.FACT_KEY, "trade_date")
    return fact, root, rollup.refresh(spark, fact, root)


def rollup_after_loads(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup after two loads, with the number of months that the second refresh had to sum again."""
    _, root, months = _rolled(spark, sf)
    return partitioned.read(spark, root).withColumn("months_again", F.lit(months))


def rollup_report(spark: SparkSession, sf: str) -> DataFrame:
    """A page query that reads the rollup alone: measures by year and country."""
    _, root, _ = _rolled(spark, sf)
    plain = table_star(spark, sf)
    star = Star(plain.fact, plain.dims["city"], plain.dims["country"], plain.dims["product"], rollup=partitioned.read(spark, root))
    return M.evaluate(star, ["exports", "balance", "balance_real"], ["year", "country_name"])


def approx_partners_sliced(spark: SparkSession, sf: str) -> DataFrame:
    """Partner countries of a slice from stored sketches, without reading facts; so few members are counted exactly,
    many within the error stated in :mod:`sketches`."""
    kept = tables.stored(sketches.member_sketches(table_star(spark, sf), "trade_country_id", ["region"]), "sketches")
    return sketches.estimated_members(kept, ["year"], FilterContext().where(year=[1997, 1998], region=["ASIA"]))


def _sliced_estimates(spark: SparkSession, sf: str, member: str) -> DataFrame:
    star, ctx = table_star(spark, sf), FilterContext().where(year=[1996, 1997, 1998], region=["ASIA", "EUROPE"])
    kept = tables.stored(sketches.member_sketches(star, member, ["region"]), "sketches")
    return sketches.with_bound(M.members_by_flag(star, member, ["year"], ctx), sketches.estimated_members(kept, ["year"], ctx), ["year"])


def partners_by_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Partner countries by year in two regions: exact, estimated, and whether within three standard errors."""
    return _sliced_estimates(spark, sf, "trade_country_id")


def cities_by_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The same for cities, of which there are many: the estimate itself depends on the sketch and is left out."""
    return _sliced_estimates(spark, sf, "city_id").drop("exports_estimate", "imports_estimate")


def category_exports_of_top_countries(spark: SparkSession, sf: str) -> DataFrame:
    """Exports by category of the ten countries with the greatest exports: a top-n as a filter."""
    star = table_star(spark, sf)
    best = ranking.top_n(M.evaluate(star, ["exports"], ["country_name"]), "exports", 10, member="country_name")
    return M.evaluate(star, ["exports"], ["product_category_name"], FilterContext().matching(best.select("country_name")))


def exports_of_best_state_years(spark: SparkSession, sf: str) -> DataFrame:
    """Exports and imports by category over pairs of state and year whose exports pass a floor: a filter on two columns,
    kept beside a choice on one of them."""
    star = table_star(spark, sf)
    pairs = M.evaluate(star, ["exports"], ["state_name", "year"]).filter("exports > 1000000").select("state_name", "year")
    ctx = FilterContext().where(year=[1996, 1997, 1998]).matching(pairs, keep=True)
    return M.evaluate(star, ["exports", "imports"], ["product_category_name"], ctx)


def rejected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Response pages by what became of them: records of the good ones, and the reason of those kept apart."""
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("text")))
    k = F.col("event_id") % 10
    page = F.when(k == 1, F.concat(F.lit('{"data":['), record)).when(k == 2, F.lit('{"data":{}}')).when(k == 3, F.lit(" ")).when(k == 4, F.lit('{"data":[]}'))
    page = page.when(k == 5, F.concat(F.lit('{"data":{"list":['), record, F.lit("]}}"))).otherwise(F.concat(F.lit('{"data":['), record, F.lit("]}")))
    pages = read(spark, sf, "events").select(F.concat(F.lit("page-"), F.col("event_id").cast("string")).alias("path"), page.alias("value"))
    kind = "id: string, text: string"
    kept = tables.stored(responses.judged(pages, responses.trade_fault(F.col("value"), kind)), "pages")
    records = responses.flatten_trade(kept.filter("reason IS NULL"), kind).agg(F.count("*")).scalar()
    outcome = kept.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("pages"), F.min("path").alias("first_path"))
    return outcome.withColumn("records", F.when(F.col("reason") == "accepted", records).otherwise(F.lit(0)))


def unreadable_values(spark: SparkSession, sf: str) -> DataFrame:
    """Event values as text, some of which are no number: by type of event, how many and the least of them."""
    text = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string"))
    rows = read(spark, sf, "events").select("event_type", text.alias("amount"))
    bad = responses.unreadable(rows, {"amount": "decimal(20,2)"})
    return bad.groupBy("event_type", "column_name", "type").agg(F.count("*").alias("rows"), F.min("value").alias("first_value"))


def empty_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest that was never written is empty and has its columns; then it holds the rows of one load."""
    path = scratch_path(spark, "manifest")
    states = {"before": tables.stored(tables.read_or_empty(spark, path, files.MANIFEST), "none")}
    rows = pipeline.landing_manifest(spark, sf).withColumn("logged_at", F.lit(None).cast(T.TimestampNTZType())).select(*files.MANIFEST.names)
    tables.append(rows, path)
    states["after"] = tables.read_or_empty(spark, path, files.MANIFEST)
    parts = [f.agg(F.count("*").alias("rows"), F.count_distinct("path").alias("files")).withColumn("state", F.lit(n)) for n, f in states.items()]
    return parts[0].unionByName(parts[1])


def upkeep_queries():
    found = (
        *(fact_partition_pointer, loads_after_stop, rollup_after_loads, rollup_report, approx_partners_sliced, partners_by_slice, cities_by_slice),
        *(category_exports_of_top_countries, exports_of_best_state_years, rejected_pages, unreadable_values, empty_manifest),
    )
    return {f.__name__: f for f in found}
