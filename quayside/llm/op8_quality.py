"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

Per text some twenty statistics are counted (shares of kinds of characters, repeated words, word lengths, ...). Standard
scores of them pass through cosines of random projections, whose inner products approximate a Gaussian kernel. Each
partition of the labelled rows sums its part of the normal equations; the parts are added in two levels, so no task and
not the driver gets more than about the square root of their number; the driver solves one small system. Isotonic
regression over at most ``BINS`` bins of the raw score turns it into a share of good texts.

All labelled rows outside the held-out fifth are used. Labels, language, source and doc_id are no inputs.

Defined results: a null or empty text has all statistics 0 and is scored as any other. A document with several labels
counts once with their mean. Without labels every score is 0.5. A document without an id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.session import scratch_path

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
FEATURES, WIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 20240817
BINS = 1000
CLIP = 6.0

_KIND = np.zeros((256, 7), bool)
for _b in range(256):
    _c = chr(_b) if _b < 0x80 else ""
    _KIND[_b] = [_c.isupper(), _c.islower(), _c.isdigit(), bool(_c) and _c.isprintable() and not _c.isalnum() and _c != " ", _b >= 0xC0, _c == "\n", _c in ".!?" and bool(_c)]
NAMES = ["words", "bytes_per_word", "upper", "lower", "digits", "marks", "beyond_ascii", "lines", "sentences", "mark_runs", "repeated", "distinct", "commonest",
         "ends_in_mark", "no_letter", "all_upper", "capital", "long_words", "one_letter", "same_byte"]


def statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of numbers for each text."""
    n, w = len(offs) - 1, ragged.words(buf, offs)
    count = np.diff(w.first)
    of = np.repeat(np.arange(n), count)
    size = np.maximum(np.diff(offs), 1)
    some = np.maximum(count, 1)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = ragged.offsets(mask)
        return total[offs[1:]] - total[offs[:-1]]

    def per_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(of, mask, n) / some

    kinds = [per_text(_KIND[:, i][buf]) for i in range(7)]
    mark = _KIND[:, 3][buf]
    doubled = np.zeros(len(buf), bool)
    doubled[1:] = mark[1:] & mark[:-1]
    same = np.zeros(len(buf), bool)
    same[1:] = buf[1:] == buf[:-1]
    length = w.end - w.start
    hashes = ragged.Rolling(buf).spans(w.start, w.end)
    again = np.zeros(len(of), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    _, first, often = np.unique(ragged.mix(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, of[first], often)
    within = lambda mask: (t := ragged.offsets(mask))[w.end] - t[w.start]
    upper, letters = within(_KIND[:, 0][buf]), within(_KIND[:, 0][buf] | _KIND[:, 1][buf] | (buf >= 0x80))
    columns = [
        np.log1p(count), np.diff(offs) / some, *(k / size for k in kinds[:5]), kinds[5] / some, kinds[6] / some, per_text(doubled) / size, per_words(again),
        np.bincount(of[first], minlength=n) / some, most / some, per_words(mark[w.end - 1]), per_words(letters == 0),
        per_words((letters > 1) & (upper == letters)), per_words(_KIND[:, 0][buf[w.start]]), per_words(length > 14), per_words(length == 1), per_text(same) / size,
    ]
    return np.stack(columns, axis=1).astype(np.float64)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    share: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(cosines(stats, self.mean, self.scale) @ self.weights, self.raw, self.share), 0, 1)


def cosines(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features, and a constant."""
    rng = np.random.default_rng(SEED)
    directions, phase = rng.normal(0, 1 / WIDTH, (len(NAMES), FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / scale, -CLIP, CLIP)
    return np.hstack([np.cos(z @ directions + phase) * np.sqrt(2 / FEATURES), np.ones((len(z), 1))])


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("stats")
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _with_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in ragged.slices(batches):
        stats = statistics(*ragged.flat(rows.column("text")))
        column = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * len(NAMES), pa.int32()), pa.array(stats.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), column], names=["doc_id", "stats"])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and label of the rows to learn from, written once since they are read three times."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    stats = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(fold() != HELD_OUT).mapInArrow(_with_stats, "doc_id long, stats array<double>")
    path = scratch_path(docs.sparkSession, "quality")
    stats.join(good, "doc_id").select("stats", "y").write.parquet(path)
    return docs.sparkSession.read.schema("stats array<double>, y double").parquet(path)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column("part"):
            one = np.frombuffer(part.as_buffer())
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = _labelled(docs, labels)
    spread = rows.select(F.posexplode("stats").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).orderBy("i").collect()
    if not spread:
        return Model(*[np.zeros(0)] * 5)
    mean, scale = np.array([r["mean"] for r in spread]), np.array([r["sd"] if r["sd"] > 1e-9 else 1.0 for r in spread])
    width = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, n = np.zeros((width, width)), np.zeros(width), 0
        for batch in batches:
            z, y = cosines(_stats_of(batch), mean, scale), batch.column("y").to_numpy()
            left, right, n = left + z.T @ z, right + z.T @ y, n + len(y)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([left.ravel(), right, [n]]).tobytes()], pa.binary())], names=["part"])

    parts = rows.mapInArrow(equations, "part binary")
    few = max(1, round(rows.rdd.getNumPartitions() ** 0.5))
    total = np.frombuffer(parts.repartition(few).mapInArrow(_summed, "part binary").repartition(1).mapInArrow(_summed, "part binary").first()["part"])
    left, right, n = total[: width * width].reshape(width, width), total[width * width : -1], total[-1]
    weights = np.linalg.solve(left + np.eye(width) * (RIDGE * n + 1e-2), right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = cosines(_stats_of(batch), mean, scale) @ weights
            bin_ = np.clip(np.floor((value + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bin_), pa.array(value), batch.column("y")], names=["bin", "raw", "y"])

    bins = rows.mapInArrow(raw, "bin int, raw double, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("raw").alias("raw"), F.avg("y").alias("y")).orderBy("bin").collect()
    return Model(mean, scale, weights, *isotonic(np.array([[r["raw"], r["n"], r["y"]] for r in bins])))


def isotonic(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending shares over ascending raw scores, by pooling neighbours that go down. Rows: raw, weight, share."""
    blocks: list[list[float]] = []
    for raw, n, y in bins.tolist():
        blocks.append([raw, n, y])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            (a, n1, y1), (b, n2, y2) = blocks[-2:]
            blocks[-2:] = [[(a * n1 + b * n2) / (n1 + n2), n1 + n2, (y1 * n1 + y2 * n2) / (n1 + n2)]]
    return np.array([b[0] for b in blocks]), np.array([b[2] for b in blocks])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: text, row (a struct of its other columns), score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.lit(0.0).alias("score"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ragged.slices(batches):
            got = sent.value.scores(statistics(*ragged.flat(rows.column("text"))))
            yield pa.RecordBatch.from_arrays([rows.column("text"), rows.column("row"), pa.array(got)], names=["text", "row", "score"])

    return found.mapInArrow(score, found.schema)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns and order of columns."""
    kept = scored(docs, fit(docs, labels)).where(F.col("score") >= threshold)
    return kept.select(*["text" if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).select("row.doc_id", "score")
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
