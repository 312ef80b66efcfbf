"""Connected components of a table of links, by alternating large and small stars.

In a large star each node gives its larger neighbours the smallest node around it; in a small star it does so with its
smaller ones. Rounds go on until nothing changes, which takes about the logarithm of the longest chain. Every round is
written to the shared folder, so lineage stays short and lost executors repeat one round only. A node with very many
links is split by the adaptive skew join, and minima are summed before shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import scratch_path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _flat(links: DataFrame) -> bool:
    """Every node has one smallest node, which has none itself: nothing is left to move."""
    twice = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    return twice.isEmpty() and links.select(F.col("v").alias("u")).distinct().join(links, "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links`` has two columns of numbers; the result has ``node`` and ``component`` (the smallest node that can be
    reached) for every node that has a link to another and is not the smallest itself."""
    a, b = links.columns
    now = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = stored(now, "links")
    while not _flat(now):
        now = stored(_small(_large(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
