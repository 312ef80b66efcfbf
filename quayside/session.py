"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the work that depends on measured sizes: it picks broadcast joins
# from shuffle statistics, splits skewed join partitions and merges small ones. The shuffle
# partition number is therefore only an upper start value; set it to 2-3x the cluster's cores.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # call sites are not recorded for each expression: plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "quayside", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent (tests on one machine) is a temporary folder used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="quayside-")
    return f"{base.rstrip('/')}/quayside/{name}-{uuid.uuid4().hex[:12]}"
