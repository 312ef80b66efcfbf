"""Sums of a partitioned fact by month and some of its keys, kept beside it and brought up to date by month.

The rollup's commit notes from which load of the fact each month was summed. A refresh compares that with the fact's
newest commit and sums again only the months that lie in another load now; those replace the rollup's months whole, and
months that the fact has no longer are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources import partitioned
from quayside.sources.tables import stored

KEYS = ("trade_date", "trade_country_id", "product_category_id", "trade_flag")
SUMS = {"fob_value": "decimal(38,2)", "fob_value_real": "decimal(38,4)", "net_weight": "decimal(38,2)"}


def summed(fact: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return fact.groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items() if c in fact.columns])


def refresh(spark: SparkSession, fact: str, root: str, keys: Sequence[str] = KEYS) -> int:
    """Brings the rollup at ``root`` up to the fact's newest version; returns the number of months summed again."""
    for left in reversed(range(partitioned.TRIES)):
        now, kept = partitioned.version(spark, fact), partitioned.version(spark, root)
        if now is None:
            return 0
        known = kept.notes if kept else {}
        months = [name for name, load in now.folders.items() if known.get(name) != load]
        gone = [name for name in known if name not in now.folders]
        if not months and not gone:
            return 0
        rows = stored(summed(partitioned.read(spark, fact, now, months), keys), "rollup")
        new = partitioned.stage(spark, root, rows, keys, now.partition, kept, whole=True)
        folders = {name: load for name, load in new.folders.items() if name in now.folders}
        try:
            partitioned.commit(spark, root, replace(new, folders=folders, notes=dict(now.folders)))
        except partitioned.Conflict:
            if not left:
                raise
            continue
        return len(months)
    return 0
