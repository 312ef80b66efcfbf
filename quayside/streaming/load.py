"""Landing files as a file stream: each file is loaded once, then merged by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.operators.cleansing import latest_per_key
from quayside.sources import partitioned


def load_landed(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    partition: str,
    newest: str,
    ties: Sequence[str] = (),
    files_per_batch: int = 1000,
) -> None:
    """Load all files not loaded yet and stop.

    The stream's checkpoint takes the place of the load manifest. A batch repeated after a failure
    merges to the same result, because the newest row of a key wins over batch and target together: an
    older copy that lands in a later file changes nothing.
    """

    def merge_batch(batch: DataFrame, _: int) -> None:
        rows = latest_per_key(batch, keys, newest, ties)
        partitioned.upsert(batch.sparkSession, target, rows, keys, partition, newest=newest, ties=ties, unique=False)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    query = rows.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
