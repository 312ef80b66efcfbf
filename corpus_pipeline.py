"""The corpus pipeline: documents go through five of the operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as
the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import op1_minhash as op1
from quayside.llm import op3_decontaminate as op3
from quayside.llm import op5_token_files as op5
from quayside.llm import op8_quality as op8
from quayside.llm import op9_mix as op9
from quayside.llm.workers import with_workers
from quayside.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    return op8.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more."""
    return op1.deduplicated(docs, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return op3.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; documents and pieces of them as often as the mix takes them."""
    return op9.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, and their digests."""
    return op5.token_files(spark, docs)


STAGES: list[tuple[str, Stage]] = [(f.__name__, with_workers(f)) for f in (quality, near_dedup, decontaminate, mix, write_tokens)]

#: The quality and the near-duplicate stage can't be expressed in SQL; run() is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
