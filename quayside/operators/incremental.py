"""High-water marks, load windows, manifests, and merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import next_month, period_name

# Load windows are five years long up to 2023 and yearly from 2024 on.
YEARLY_FROM, LONG_WINDOW = 2024, 5
INDEX_WINDOW = 11
EARLIEST = date(1900, 1, 1)


class DuplicateKeys(ValueError):
    """A merge source holds a key twice."""


def high_water_mark(target: DataFrame, column: str) -> Column:
    """max(column), 1900-01-01 for an empty target, as a scalar subquery."""
    return target.agg(F.coalesce(F.max(column), F.lit(EARLIEST).cast(target.schema[column].dataType))).scalar()


def marks_by(rows: DataFrame, by: str, column: str) -> DataFrame:
    return rows.groupBy(by).agg(F.max(column).alias("mark"))


def newer_than(rows: DataFrame, target: DataFrame, column: str, or_equal: bool = False) -> DataFrame:
    """Rows past the target's mark (``or_equal`` also takes the mark's own period again)."""
    mark = high_water_mark(target, column)
    return rows.filter(F.col(column) >= mark if or_equal else F.col(column) > mark)


def ingestion_plan(flows: DataFrame, marks: DataFrame, source_last: DataFrame, start_year: int, final_year: int | None = None):
    """(flow, action, date_from, date_to): what to load next for each flow.

    ``flows`` (flow), ``marks`` (flow, mark) and ``source_last`` (flow, last_date). A flow without a
    mark starts at ``start_year`` and ends at the source's last month or the final year's December,
    whichever comes first; with a mark it goes on from the month after it.
    """
    known = flows.join(marks, "flow", "left").join(source_last, "flow", "left")
    mark, last = F.col("mark"), F.col("last_date")
    first_end = last if final_year is None else F.when(F.year(last) <= final_year, last).otherwise(F.lit(date(final_year, 12, 1)))
    action = F.when(mark.isNull(), "first").when(last > mark, "next").otherwise("skip")
    date_from = F.when(mark.isNull(), F.lit(date(start_year, 1, 1))).when(last > mark, next_month(mark))
    date_to = F.when(mark.isNull(), first_end).when(last > mark, last)
    return known.select("flow", action.alias("action"), date_from.alias("date_from"), date_to.alias("date_to"))


def _years(first: Column, last: Column, step: int) -> Column:
    """first, first + step, ... up to last; nothing when first is past last."""
    return F.when(first <= last, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def load_windows(plan: DataFrame, yearly_from: int = YEARLY_FROM, long_window: int = LONG_WINDOW) -> DataFrame:
    """Each (date_from, date_to) row cut into request windows ``window_from``..``window_to`` (``yyyy-MM``).

    Windows start in January, even when ``date_from`` does not: months may be fetched again, and the
    newest copy wins later.
    """
    y0, y1 = F.year("date_from"), F.year("date_to")
    old_end = F.least(F.lit(yearly_from - 1), y1)
    starts = F.concat(_years(y0, old_end, long_window), _years(F.greatest(F.lit(yearly_from), y0), y1, 1))
    s = F.col("_start")
    end = F.when(s >= yearly_from, s).otherwise(F.least(s + long_window - 1, old_end))
    return (
        plan.filter(F.col("date_from").isNotNull())
        .withColumn("_start", F.explode(starts))
        .withColumn("window_from", F.concat(s.cast("string"), F.lit("-01")))
        .withColumn(
            "window_to",
            F.when(end < y1, F.concat(end.cast("string"), F.lit("-12"))).otherwise(period_name(F.col("date_to"))),
        )
        .drop("_start")
    )


def index_windows(spans: DataFrame, width: int = INDEX_WINDOW) -> DataFrame:
    """(start_year, end_year) rows cut into blocks of ``width`` years; the last year is always kept."""
    start = F.explode(_years(F.col("start_year"), F.col("end_year"), width))
    return spans.withColumn("block_from", start).withColumn("block_to", F.least(F.col("block_from") + width - 1, F.col("end_year")))


def pending(landed: DataFrame, loaded: DataFrame, key: str = "path") -> DataFrame:
    """Landed files not loaded yet, all of them when several wait."""
    return landed.join(loaded.select(key).distinct(), key, "left_anti")


def manifest_rows(files: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One manifest row per file and configured code."""
    return files.withColumn("heading_code", F.explode(F.array(*[F.lit(c) for c in codes])))


def manifest_rows_known(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """One manifest row per file and code already landed for its flow."""
    return files.join(manifest.select("flow", "heading_code").distinct(), "flow")


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``new`` replace rows of ``old`` with the same key. Columns only grow."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice; only a sample key is brought to the driver.

    As many different hashes as rows mean as many different keys: the keys themselves are grouped only where they do not.
    """
    total, hashes = rows.agg(F.count("*"), F.count_distinct(F.xxhash64(*keys))).first()
    if total == hashes:
        return
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).collect()
    if twice:
        raise DuplicateKeys(f"key {tuple(twice[0])[:-1]} occurs {twice[0]['n']} times")


def insert_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Insert-only members: existing ones keep their attributes."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)
