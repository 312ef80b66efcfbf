"""Makes this package importable in the Python workers of a session that was started elsewhere.

On a cluster whose machines do not share the source folder, ship the package with ``--py-files`` as usual.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def with_workers(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a function whose first argument is the session."""

    @functools.wraps(f)
    def call(spark: SparkSession, *rest) -> DataFrame:
        importable(spark)
        return f(spark, *rest)

    return call
