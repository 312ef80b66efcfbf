"""Parquet tables: snapshot, append, and versioned upsert; partitioned ones are in ``partitioned``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.incremental import insert_new, merge, require_unique
from quayside.session import scratch_path


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path in its form."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return fs.exists(jpath)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table, or an empty frame of the declared schema when nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def write_snapshot(frame: DataFrame, path: str) -> None:
    """Replace the whole table."""
    frame.write.mode("overwrite").parquet(path)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared scratch folder and read back, for results used many times."""
    path = scratch_path(frame.sparkSession, name)
    write_snapshot(frame, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def append(frame: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    sized(frame, partition).write.mode("append").partitionBy(*partition).parquet(path)


def sized(frame: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Rows of one partition together, but a large partition over several tasks and files."""
    return frame.hint("rebalance", *[F.col(c) for c in partition]) if partition else frame


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    fs, _ = file_system(spark, path)
    done = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS"))
    return sorted(int(str(s.getPath().getParent().getName()).split("=")[1]) for s in done or [])


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version; an interrupted write leaves no _SUCCESS file and is not seen."""
    versions = _versions(spark, path)
    return spark.read.parquet(f"{path}/version={versions[-1]}") if versions else None


def write_version(spark: SparkSession, path: str, frame: DataFrame) -> None:
    versions = _versions(spark, path)
    frame.write.mode("overwrite").parquet(f"{path}/version={versions[-1] + 1 if versions else 1}")


def upsert_version(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str]) -> None:
    """Merge into an unpartitioned table as a new version beside the one being read."""
    new = stored(new, "merge")
    require_unique(new, keys)
    old = read_current(spark, path)
    write_version(spark, path, new if old is None else merge(old, new, keys))


def insert_new_version(spark: SparkSession, path: str, new: DataFrame, key: str) -> None:
    """Add members not in the table yet; members already there stay as they are."""
    new = stored(new, "members")
    require_unique(new, [key])
    old = read_current(spark, path)
    write_version(spark, path, new if old is None else insert_new(old, new, key))
