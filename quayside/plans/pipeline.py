"""Pipeline stages over the order tables, from bronze text to checked gold, as named queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import month_start
from quayside.functions.numbers import money
from quayside.functions.text import normalize_name
from quayside.operators import incremental, quality
from quayside.operators.cleansing import all_as_text, ambiguous_names, heading_filter, latest_per_key
from quayside.operators.inflation import deflate
from quayside.plans import gold, silver
from quayside.plans import table_bronze as B
from quayside.plans.table_star import price_index, read, trade_lines
from quayside.session import scratch_path
from quayside.sources import files, partitioned, responses, tables
from quayside.streaming.load import load_landed

# customer numbers and part types are longer than the codes they stand for
WIDTHS = silver.Widths(city=19, heading=25)
CUT = date(2000, 12, 1)


def silver_side(spark: SparkSession, sf: str, flag: str, target: DataFrame | None = None) -> DataFrame:
    cities = latest_per_key(B.bronze_cities(spark, sf), ["id"])  # bronze holds a copy per load
    countries = B.country_names(spark, sf)
    return silver.silver_trades(B.bronze_trades(spark, sf, flag), cities, countries, flag, B.RUN_AT, target, WIDTHS)


def unknown_members(spark: SparkSession, sf: str) -> DataFrame:
    """Exports that meet on a key only because their city is not known: how many keys and records, and their values."""
    cities, countries = latest_per_key(B.bronze_cities(spark, sf), ["id"]), B.country_names(spark, sf)
    return silver.unknown_report(silver.resolved_trades(B.bronze_trades(spark, sf, "exp"), cities, countries, "exp", B.RUN_AT, widths=WIDTHS))


def cut_values(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that headings of four letters and descriptions of 18 would cut, with what would be left of them."""
    return quality.cut_values(B.product_seed(spark, sf), "seed_product_categories", {"product_category_id": 4, "product_category_description": 18})


def cities_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_cities(
        B.bronze_cities(spark, sf), B.bronze_states(spark, sf), B.state_regions(spark, sf), B.RUN_AT, widths=WIDTHS
    )


def countries_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_countries(B.bronze_countries(spark, sf), B.RUN_AT)


def index_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_index(B.bronze_index(spark, sf), B.RUN_AT)


def silver_exports_since(spark: SparkSession, sf: str) -> DataFrame:
    """Exports again from the month up to which the target is filled."""
    filled = read(spark, sf, "lineitem").select(month_start(F.col("l_shipdate")).alias("trade_date"))
    return silver_side(spark, sf, "exp", filled.filter(F.col("trade_date") <= F.lit(CUT)))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """Both directions with real values; the index, read several times, is a written table."""
    imports, exports = silver_side(spark, sf, "imp"), silver_side(spark, sf, "exp")
    index = tables.stored(index_silver(spark, sf), "silver-index")
    return gold.fact_trades(imports, exports, index, B.RUN_AT)


def fact_since(spark: SparkSession, sf: str) -> DataFrame:
    """Frozen form: only months from the target's latest on get new real values, older rows keep theirs."""
    sides = [_grain(spark, sf).filter(F.col("trade_flag") == f) for f in ("imp", "exp")]
    index = price_index(spark, sf)
    early = index.filter(F.col("cpi_date") <= F.lit(CUT))
    old = deflate(_grain(spark, sf).filter(F.col("trade_date") <= F.lit(CUT)), early)
    old = old.withColumn("created_at", F.lit(B.FIRST_LOAD).cast("timestamp_ntz")).select(*gold.FACT_COLUMNS)
    new = gold.fact_trades(*sides, index, B.RUN_AT, target=old)
    return incremental.merge(old, new, gold.FACT_KEY)


def _grain(spark: SparkSession, sf: str) -> DataFrame:
    """The trade star's own grain: month, city, country, category, direction."""
    lines = trade_lines(spark, sf, frozenset({"city_id", "trade_country_id", "product_category_id"}))
    sums = [F.sum(c).cast("decimal(20,2)").alias(c) for c in ("fob_value", "net_weight")]
    return lines.groupBy("trade_date", "city_id", "trade_country_id", "product_category_id", "trade_flag").agg(*sums)


def dim_cities_with_new(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of one segment are members already, under older names; the rest is new."""
    customer = read(spark, sf, "customer").select(F.col("c_custkey").alias("city_id"), F.col("c_name").alias("city_name"), "c_mktsegment")
    old = customer.filter(F.col("c_mktsegment") == "MACHINERY").withColumn("city_name", F.upper("city_name"))
    return incremental.insert_new(old, customer, "city_id")


def silver_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Silver tests: each table is built and read once, whatever the number of tests."""
    sides = [silver_side(spark, sf, f) for f in ("exp", "imp")]
    return gold.silver_tests(*sides, cities_silver(spark, sf), countries_silver(spark, sf), index_silver(spark, sf))


def gold_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Gold tests, with an unknown member in both name-resolved dimensions; those are read as parents, too."""
    run_at = silver.run_time(B.RUN_AT)
    cities = quality.with_unknown_member(gold.dim_cities(cities_silver(spark, sf), B.RUN_AT), "city_id", created_at=run_at)
    countries = quality.with_unknown_member(gold.dim_countries(countries_silver(spark, sf), B.RUN_AT), "country_id", created_at=run_at)
    products = gold.dim_product_categories(B.product_seed(spark, sf), WIDTHS)
    dims = [tables.stored(d, "dimension") for d in (cities, countries, products)]
    return gold.star_tests(fact(spark, sf), *dims)


def order_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Key tests on the order tables themselves."""
    lineitem, orders, customer, nation = (read(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    broken = orders.withColumn("o_custkey", F.when(F.col("o_orderpriority") == "5-LOW", -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    return quality.report(
        quality.not_null(lineitem, "lineitem", lineitem.columns),
        quality.unique(orders, "orders", ["o_orderkey"]),
        quality.unique(lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.relationships(lineitem, "lineitem", "l_orderkey", orders, "o_orderkey"),
        quality.relationships(customer, "customer", "c_nationkey", nation, "n_nationkey"),
        quality.relationships(broken, "orders", "o_custkey", customer, "c_custkey"),
    )


def normalized_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = read(spark, sf, "documents").select("doc_id", "text")
    return documents.select("doc_id", normalize_name(F.col("text")).alias("normalized"))


def shared_customer_names(spark: SparkSession, sf: str) -> DataFrame:
    return ambiguous_names(read(spark, sf, "customer"), "c_name", "c_custkey")


def trade_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Events wrapped in response pages of both shapes, then flattened."""
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("text"), "props"))
    wrapped = F.format_string('{"data":{"list":[%s]}}', record)
    bare = F.format_string('{"data":[%s],"success":true}', record)
    pages = read(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, wrapped).otherwise(bare).alias("value"))
    return responses.flatten_trade(pages, "id: string, text: string, props: string")


def index_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Events as index responses, some of them refused, flattened to text columns."""
    record = F.to_json(F.struct(F.col("event_id").alias("year"), F.col("event_type").alias("period"), F.col("user_id").alias("value")))
    status = F.when(F.col("event_type") == "error", "REQUEST_NOT_PROCESSED").otherwise(responses.SUCCEEDED)
    page = F.format_string('{"status":"%s","message":[],"Results":{"series":[{"seriesID":"s","data":[%s]}]}}', status, record)
    pages = read(spark, sf, "events").select(page.alias("value"))
    return all_as_text(responses.flatten_index(pages, "year: bigint, period: string, value: bigint"))


def _landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """One landing file name per direction and shipping year."""
    lines = trade_lines(spark, sf, frozenset())
    spans = lines.groupBy("trade_flag", F.year("trade_date").alias("y")).agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    flow = F.when(F.col("trade_flag") == "exp", "export").otherwise("import")
    return spans.select(files.landing_name("trade", flow, F.col("a"), F.col("b")).alias("path"))


def landing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Period and direction read off each file name, one row per file and heading."""
    landed = _landed_files(spark, sf).withColumns(files.file_period(F.col("path")))
    return incremental.manifest_rows(landed, ["0301", "0302", "0303", "0304", "0305", "0306", "0307", "0308"])


def pending_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files past the years already loaded; every waiting file is listed."""
    landed = _landed_files(spark, sf).withColumns(files.file_period(F.col("path")))
    loaded = landed.filter(F.col("date_to") < F.lit(date(1999, 1, 1)))
    return incremental.pending(landed, loaded).select("path", "flow", "date_from", "date_to")


def flow_marks(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.marks_by(trade_lines(spark, sf, frozenset()), "trade_flag", "trade_date")


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    """Flows are order priorities; two have no mark, one is up to date, the others lag."""
    orders = read(spark, sf, "orders").select(F.col("o_orderpriority").alias("flow"), month_start(F.col("o_orderdate")).alias("d"))
    flows = orders.select("flow").distinct()
    last = incremental.marks_by(orders, "flow", "d").withColumnRenamed("mark", "last_date")
    seen = orders.filter(
        (F.col("flow") == "1-URGENT")
        | ((F.col("flow") == "2-HIGH") & (F.col("d") < F.lit(date(1997, 1, 1))))
        | ((F.col("flow") == "3-MEDIUM") & (F.col("d") < F.lit(date(1998, 4, 1))))
    )
    return incremental.ingestion_plan(flows, incremental.marks_by(seen, "flow", "d"), last, 1993)


def load_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Request windows of the plan; yearly ones start in 1999 here."""
    return incremental.load_windows(_plan(spark, sf), yearly_from=1999)


def index_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Index blocks of at most four years from 1992 to each priority's last order."""
    years = read(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("flow")).agg(F.max(F.year("o_orderdate")).alias("end_year"))
    return incremental.index_windows(years.withColumn("start_year", F.lit(1992)), 4)


def changed_customers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customer = read(spark, sf, "customer").withColumn("c_acctbal", money(F.col("c_acctbal")))
    changed = customer.filter(F.col("c_mktsegment") == "BUILDING").withColumns(
        {"c_acctbal": (F.col("c_acctbal") + 100).cast("decimal(20,2)"), "note": F.lit("raised")}
    )
    fresh = changed.withColumn("c_custkey", -F.col("c_custkey") - 1)
    return customer, changed.unionByName(fresh)


def customer_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Changed and new customers merged in; the new column is added, empty for rows not touched."""
    old, new = changed_customers(spark, sf)
    return incremental.merge(old, new, ["c_custkey"])


def customer_version_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a versioned table; the second identical upsert changes nothing."""
    old, new = changed_customers(spark, sf)
    path = scratch_path(spark, "customer")
    tables.upsert_version(spark, path, old, ["c_custkey"])
    for _ in range(2):
        tables.upsert_version(spark, path, new, ["c_custkey"])
    return tables.read_current(spark, path)


def fact_partition_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """First load up to a cut month, then the months from it on with corrected weights, by month partition."""
    path = scratch_path(spark, "fact")
    rows = _grain(spark, sf)
    partitioned.upsert(spark, path, rows.filter(F.col("trade_date") <= F.lit(CUT)), gold.FACT_KEY, "trade_date")
    later = rows.filter(F.col("trade_date") >= F.lit(CUT))
    later = later.withColumn("net_weight", (F.col("net_weight") + 1).cast("decimal(20,2)"))
    partitioned.upsert(spark, path, later, gold.FACT_KEY, "trade_date")
    return partitioned.read(spark, path).select(*gold.FACT_KEY, "fob_value", "net_weight")


def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Import records under one key, all copies."""
    return B.bronze_trades(spark, sf, "imp").select(
        F.concat_ws("|", F.coalesce("noMunMinsgUf", F.lit("-")), "country", F.coalesce("headingCode", F.lit("-"))).alias("record"),
        F.concat("year", F.lit("-"), "monthNumber").alias("period"),
        "metricKG", "metricFOB", "loaded_at",
    )


def streamed_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings loaded as a file stream; copies of a record collapse to the newest."""
    base = scratch_path(spark, "stream")
    landed = landed_records(spark, sf)
    schema = landed.schema
    for stamp in (B.FIRST_LOAD, B.SECOND_LOAD):
        tables.append(landed.filter(F.col("loaded_at") == F.lit(stamp).cast("timestamp_ntz")), f"{base}/landing")
        load_landed(
            spark, f"{base}/landing", schema, f"{base}/target", f"{base}/progress",
            ["record", "period"], "period", "loaded_at", ("metricFOB", "metricKG"),
        )
    return partitioned.read(spark, f"{base}/target")


def landing_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Trades written by flow and period, reread with the declared schema, counted per partition."""
    path = scratch_path(spark, "landing")
    for flag, flow in (("exp", "export"), ("imp", "import")):
        rows = B.bronze_trades(spark, sf, flag)
        rows = rows.withColumns({"flow": F.lit(flow), "period": F.concat("year", "monthNumber")})
        tables.append(rows, path, ["flow", "period"])
    schema = T.StructType([*files.TRADE_RECORD, T.StructField("flow", T.StringType()), T.StructField("period", T.StringType())])
    back = spark.read.schema(schema).parquet(path)
    kg = F.sum(F.col("metricKG").cast("decimal(20,2)")).cast("decimal(38,2)")
    return back.groupBy("flow", "period").agg(F.count(F.lit(1)).alias("records"), kg.alias("kg"))


def chapter_headings(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of one chapter by prefix and suffix; part sizes stand for headings."""
    code = F.lpad(F.col("p_size").cast("string"), 2, "0")
    heading = F.concat(F.lit("03"), code)
    parts = read(spark, sf, "part").select(heading.alias("heading_code")).distinct()
    return parts.filter(heading_filter(F.col("heading_code")))


def pipeline_queries():
    return {
        "silver_exports": lambda s, sf: silver_side(s, sf, "exp"),
        "silver_imports": lambda s, sf: silver_side(s, sf, "imp"),
        "silver_exports_incremental": silver_exports_since,
        "silver_cities": cities_silver,
        "silver_countries": countries_silver,
        "silver_index": index_silver,
        "fact_trades": fact,
        "fact_trades_incremental": fact_since,
        "dim_cities_insert_only": dim_cities_with_new,
        "dim_countries": lambda s, sf: gold.dim_countries(countries_silver(s, sf), B.RUN_AT),
        "dim_product_categories": lambda s, sf: gold.dim_product_categories(B.product_seed(s, sf), WIDTHS),
        "quality_silver": silver_quality,
        "quality_gold": gold_quality,
        "quality_orders": order_quality,
        "normalized_documents": normalized_documents,
        "ambiguous_customer_names": shared_customer_names,
        "trade_response_records": trade_responses,
        "index_response_records": index_responses,
        "landing_manifest": landing_manifest,
        "pending_files": pending_files,
        "flow_marks": flow_marks,
        "ingestion_plan": _plan,
        "load_windows": load_windows,
        "index_windows": index_windows,
        "customer_upsert": customer_upsert,
        "customer_version_upsert": customer_version_upsert,
        "fact_partition_upsert": fact_partition_upsert,
        "streamed_load": streamed_load,
        "landing_round_trip": landing_round_trip,
        "chapter_headings": chapter_headings,
        "unknown_members": unknown_members,
        "cut_values": cut_values,
    }
