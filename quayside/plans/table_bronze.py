"""Bronze text records made from the order tables, with the faults the cleaning rules are for.

Customers stand for cities, supplier nations for countries. Faults are spread by customer number:
names missing or unknown, headings or values missing, and reloads that correct or void a record.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import month_start
from quayside.plans.table_star import price_index, read, trade_lines

FIRST_LOAD, SECOND_LOAD = datetime(2024, 1, 1), datetime(2024, 2, 1)
RUN_AT = datetime(2024, 3, 1)


def letters(number: Column, width: int) -> Column:
    """A number spelled in the letters a-j, so normalised names stay distinct."""
    return F.translate(F.lpad(number.cast("string"), width, "0"), "0123456789", "abcdefghij")


def loaded(rows: DataFrame, at: datetime) -> DataFrame:
    stamp = F.lit(at).cast("timestamp_ntz")
    return rows.withColumn("ingested_at", stamp).withColumn("loaded_at", stamp)


def bronze_trades(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    # nations meet the orders, of which there are fewer than records; a customer's rows stay together till each gives a record
    customers = read(spark, sf_dir, "customer").groupBy("c_custkey").agg(F.collect_list(F.struct("c_nationkey")).alias("nations"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    lines = trade_lines(spark, sf_dir, frozenset({"city_id", "trade_country_id", "product_category_id"}), orders=orders)
    grain = (
        lines.filter(F.col("trade_flag") == flag)
        .groupBy("city_id", "trade_date", "trade_country_id", "product_category_id", "nations")
        .agg(F.sum("fob_value").alias("fob"), F.sum("net_weight").alias("kg"))
    )
    c = F.col("city_id").cast("bigint")
    uf = F.upper(letters(F.col("c_nationkey"), 2))
    # one pass emits the first copy and, where a record was loaded again, the second
    copies = F.when(c % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    second = F.col("copy") == 2
    fob = (
        F.when(second & (c % 70 == 0), F.lit("0"))
        .when(second, (F.col("fob") + 1).cast("decimal(38,2)").cast("string"))
        .when(c % 79 != 0, F.col("fob").cast("decimal(38,2)").cast("string"))
    )
    rows = grain.select("*", F.inline_outer("nations")).withColumn("copy", F.explode(copies))
    stamp = F.when(second, F.lit(SECOND_LOAD).cast("timestamp_ntz")).otherwise(F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    return rows.select(
        F.when(c % 97 == 0, None)
        .when(c % 89 == 0, "Sem Cadastro")
        .otherwise(F.concat(F.lit("CIDADE "), F.upper(letters(c, 9)), F.lit(" - "), uf))
        .alias("noMunMinsgUf"),
        F.year("trade_date").cast("string").alias("year"),
        F.date_format("trade_date", "MM").alias("monthNumber"),
        F.concat(F.lit("NACAO "), F.upper(letters(F.col("trade_country_id"), 2))).alias("country"),
        uf.alias("state"),
        F.when(c % 83 != 0, F.col("product_category_id")).alias("headingCode"),
        F.col("product_category_id").alias("heading"),
        fob.alias("metricFOB"),
        F.col("kg").cast("decimal(38,2)").cast("string").alias("metricKG"),
        stamp.alias("ingested_at"),
        stamp.alias("loaded_at"),
    )


def bronze_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities; every tenth was loaded again under its present name."""
    customers = read(spark, sf_dir, "customer")
    name = F.concat(F.lit("Cidáde "), F.initcap(letters(F.col("c_custkey"), 9)))
    base = customers.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(name, F.lit(" - "), F.upper(letters(F.col("c_nationkey"), 2)), F.lit(" ")).alias("text"),
        name.alias("noMunMin"),
        F.col("c_custkey").alias("k"),
    )
    old = base.filter(F.col("k") % 10 == 0).withColumn("noMunMin", F.concat(F.lit("Antiga "), "noMunMin"))
    return loaded(base, SECOND_LOAD).unionByName(loaded(old, FIRST_LOAD)).drop("k")


def bronze_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.upper(letters(F.col("n_nationkey"), 2))
    return read(spark, sf_dir, "nation").select(code.alias("id"), F.col("n_name").alias("text"), code.alias("uf"))


def state_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of each state; the states of region 4 are not listed."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter(F.col("r_regionkey") < 4)
    return joined.select(F.upper(letters(F.col("n_nationkey"), 2)).alias("uf"), F.col("r_name").alias("region"))


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list fact records are looked up in: a small file, so the planner knows it is small."""
    return _countries(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")))


def _countries(keys: DataFrame) -> DataFrame:
    name = F.concat(F.lit("Nação "), F.initcap(letters(F.col("k"), 2)))
    return keys.select(F.col("k").cast("string").alias("id"), name.alias("text"))


def bronze_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of the suppliers, loaded twice."""
    rows = _countries(read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).distinct())
    old = rows.withColumn("text", F.upper("text"))
    return loaded(rows, SECOND_LOAD).unionByName(loaded(old, FIRST_LOAD))


def bronze_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index values as text, with a missing mark in the gap months and a yearly row per year."""
    months = read(spark, sf_dir, "lineitem").select(month_start(F.col("l_shipdate")).alias("d")).distinct()
    known = price_index(spark, sf_dir)
    rows = months.join(known, F.col("d") == F.col("cpi_date"), "left").select(
        F.year("d").cast("string").alias("year"),
        F.concat(F.lit("M"), F.date_format("d", "MM")).alias("period"),
        F.coalesce(F.col("cpi_value").cast("string"), F.lit("-")).alias("value"),
    )
    yearly = rows.select("year").distinct().select("year", F.lit("M13").alias("period"), F.lit("999.99").alias("value"))
    return loaded(rows.unionByName(yearly), FIRST_LOAD)


def product_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = read(spark, sf_dir, "part").select("p_type").distinct()
    return kinds.select(
        F.col("p_type").alias("product_category_id"),
        F.col("p_type").alias("product_category_name"),
        F.concat(F.lit("Parts of type "), F.lower("p_type")).alias("product_category_description"),
    )
