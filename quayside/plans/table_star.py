"""The trade star read off the order tables: a shipped line is a trade, its status the direction.

line status O is an export and F an import; the customer is the city, the customer's nation the
state, the supplier's nation the partner country, and the part type the product category.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import month_start
from quayside.operators.inflation import deflate
from quayside.plans.star import KEY_OF, Bridge, Star

# The stand-in price index (100 in January 1995, a quarter point more each month) and
# the months left out.
INDEX_START = date(1995, 1, 1)
INDEX_GAPS = (date(1996, 3, 1), date(1999, 8, 1))


# Declared, so no job has to open files before the plan is made.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cpi_date, cpi_value): one row for every month from the lines' first to their last, but the gaps."""
    span = read(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    months = span.select(F.explode(F.sequence(month_start(F.col("first")), month_start(F.col("last")), F.expr("interval 1 month"))).alias("cpi_date"))
    k = F.months_between("cpi_date", F.lit(INDEX_START)).cast("int")
    return months.filter(~F.col("cpi_date").isin(*INDEX_GAPS)).select(
        "cpi_date", (F.lit(100) + k * F.lit(0.25).cast("decimal(4,2)")).cast("decimal(20,2)").alias("cpi_value")
    )


def cents(c: Column) -> Column:
    """A double holding whole cents as decimal(20,2); much cheaper than casting the double itself."""
    whole = F.rint(c * 100).cast("bigint").cast("decimal(18,0)")
    return (whole * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(20,2)")


def _following_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


SOURCES = frozenset({"l_suppkey", "l_partkey"})


def supplier_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier")
    return suppliers.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("trade_country_id"))


def part_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part")
    return parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_category_id"))


def trade_lines(spark: SparkSession, sf_dir: str, keys: frozenset, lo: date | None = None, hi: date | None = None, orders: DataFrame | None = None):
    """Line-level trades. Sums are additive, so measures group these directly: no extra shuffle to a grain.

    Columns of ``orders`` beside its two keys, when it is given, become columns of the order's trades.
    """
    lines = read(spark, sf_dir, "lineitem")
    # bounds on the month become bounds on the shipping time, which reach the file scan
    if lo is not None:
        first = lo if lo.day == 1 else _following_month(lo)
        lines = lines.filter(F.col("l_shipdate") >= F.lit(datetime(first.year, first.month, 1)).cast("timestamp_ntz"))
    if hi is not None:
        end = _following_month(hi)
        lines = lines.filter(F.col("l_shipdate") < F.lit(datetime(end.year, end.month, 1)).cast("timestamp_ntz"))
    out = {
        "trade_date": month_start(F.col("l_shipdate")),
        "trade_flag": F.when(F.col("l_linestatus") == "O", "exp").otherwise("imp"),
        "fob_value": cents(F.col("l_extendedprice")),
        "net_weight": cents(F.col("l_quantity")),
    }
    for source in SOURCES & keys:
        out[source] = F.col(source)
    joins = keys & set(KEY_OF.values())
    if "city_id" in joins:
        orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey") if orders is None else orders
        out |= {c: F.col(c) for c in orders.columns if c not in ("o_orderkey", "o_custkey")}
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        out["city_id"] = F.col("o_custkey").cast("string")
    if "trade_country_id" in joins:
        lines = lines.join(supplier_country(spark, sf_dir), "l_suppkey", "left")
        out["trade_country_id"] = F.col("trade_country_id")
    if "product_category_id" in joins:
        lines = lines.join(part_category(spark, sf_dir), "l_partkey", "left")
        out["product_category_id"] = F.col("product_category_id")
    trades = lines.select(*[c.alias(n) for n, c in out.items()])
    if "fob_value_real" in keys:
        trades = deflate(trades, price_index(spark, sf_dir))
    return trades


def table_star(spark: SparkSession, sf_dir: str) -> Star:
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    states = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    cities = (
        read(spark, sf_dir, "customer")
        .join(states, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("city_id"),
            F.col("c_name").alias("city_name"),
            F.concat_ws(" - ", "c_name", F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("city_uf"),
            F.col("n_name").alias("state_name"),
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("uf"),
            F.col("r_name").alias("region"),
        )
    )
    countries = nation.select(
        F.col("n_nationkey").cast("string").alias("country_id"), F.col("n_name").alias("country_name")
    )
    products = (
        read(spark, sf_dir, "part")
        .select(F.col("p_type").alias("product_category_id"), F.col("p_type").alias("product_category_name"))
        .distinct()
    )
    # many lines per supplier and part: sum by those before looking up country and category
    bridges = {
        "trade_country_id": Bridge("l_suppkey", supplier_country(spark, sf_dir)),
        "product_category_id": Bridge("l_partkey", part_category(spark, sf_dir)),
    }
    return Star(lambda keys, lo, hi: trade_lines(spark, sf_dir, keys, lo, hi), cities, countries, products, bridges)
