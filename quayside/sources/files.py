"""Landing files, seeds, and the period in a file's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import parse_period_code, period_code

# Fixed value: <table>_<flow>_<yyyyMM from>_<yyyyMM to>.parquet
FILE_NAME = r"^(.+)_(export|import)_(\d{6})_(\d{6})\.parquet$"

TRADE_RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("noMunMinsgUf", "year", "monthNumber", "country", "state", "headingCode", "heading", "metricFOB", "metricKG")]
    + [T.StructField(n, T.TimestampNTZType()) for n in ("ingested_at", "loaded_at")]
)
MANIFEST = T.StructType(
    [
        T.StructField("heading_code", T.StringType()),
        T.StructField("flow", T.StringType()),
        T.StructField("date_from", T.DateType()),
        T.StructField("date_to", T.DateType()),
        T.StructField("path", T.StringType()),
        T.StructField("logged_at", T.TimestampNTZType()),
    ]
)
PRODUCT_SEED = "product_category_id string, product_category_name string, product_category_description string"
REGION_SEED = "uf string, region string"

# Region of each state.
REGIONS = {
    "Norte": "AC AM AP PA RO RR TO",
    "Nordeste": "AL BA CE MA PB PE PI RN SE",
    "Centro-Oeste": "DF GO MT MS",
    "Sudeste": "ES MG RJ SP",
    "Sul": "PR RS SC",
}


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_period(path: Column) -> dict[str, Column]:
    """table, flow, date_from and date_to read off a landing file's name."""
    name = file_name(path)
    part = lambda k: F.regexp_extract(name, FILE_NAME, k)
    known = name.rlike(FILE_NAME)
    return {
        "table": F.when(known, F.concat_ws("_", part(1), part(2))),
        "flow": F.when(known, part(2)),
        "date_from": F.when(known, parse_period_code(part(3))),
        "date_to": F.when(known, parse_period_code(part(4))),
    }


def landing_name(table: str, flow: Column, date_from: Column, date_to: Column) -> Column:
    return F.concat(F.lit(f"{table}_"), flow, F.lit("_"), period_code(date_from), F.lit("_"), period_code(date_to), F.lit(".parquet"))


def read_landing(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All landed files of a folder in one scan, with the path of each row's file."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    return rows.withColumn("path", F.col("_metadata.file_path"))


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """(path, flow, date_from, date_to) of the landed files; file contents are not read.

    A folder with a landing file's name is one landed file, written in parts.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", r"^(.*_(?:export|import)_\d{6}_\d{6}\.parquet)/[^/]+$", 1)
    units = found.select(F.when(folder != "", folder).otherwise(F.col("path")).alias("path")).distinct()
    return units.withColumns({k: v for k, v in file_period(F.col("path")).items() if k != "table"})


def read_seed(spark: SparkSession, path: str, delimiter: str, schema: str) -> DataFrame:
    """A seed file with declared types; ids stay text, so leading zeros stay too."""
    return spark.read.csv(path, sep=delimiter, schema=schema, header=True, mode="FAILFAST")


def state_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(uf, r) for r, ufs in REGIONS.items() for uf in ufs.split()], REGION_SEED)
