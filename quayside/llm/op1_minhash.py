"""MinHash near-dedup with tensored banding.

A document's set holds the hashes of its distinct word shingles. Two small collections of ``BANDS`` minima each, every
one of ``DEPTH`` min-hashes, stand for it; a table's key joins one of the first collection with one of the second, so
``BANDS`` squared tables cost 2 * BANDS * DEPTH min-hashes. At a similarity of 0.8 a pair misses every table with a
probability of 2 * (1 - 0.8^DEPTH)^BANDS, or 2 in 100,000.

1. Documents with the same set become one, counted by a fingerprint of 128 bits.
2. Only halves of keys that another document shares too are joined to keys.
3. Documents that meet in a table are joined to the smallest one there; the components of these links are candidate
   clusters. A cluster holds every pair that met, and more.
4. Clusters are cut into blocks of documents of like size, and every two blocks that could hold a link are verified on
   the full sets, so no group goes to one task, and no pairs are written: a block gives a spanning forest of its links.
5. The components of the verified links are the result.

Defined results: a null or empty text, or one without words, has an empty set and links with nothing. Rows that repeat an
id are one document in the links, each with its own n_shingles. A document without an id has no component and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.links import components, stored

SHINGLE, PERCENT = 4, 80
BANDS, DEPTH = 16, 3
#: Documents and shingles of a block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 18

_U = np.uint64
_MINIMA = 2 * BANDS * DEPTH
_SEEDS = ragged.mix(np.arange(1, _MINIMA + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all sets, ascending in each text, and where each text's begin and end."""
    buf = ragged.LOWER[buf]
    w = ragged.words(buf, offs)
    word = ragged.Rolling(buf).spans(w.start, w.end)
    count = np.diff(w.first)
    # one shingle at least for a text that has a word; a shorter text's only shingle is its whole sequence
    n = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    of = np.repeat(np.arange(len(count)), n)
    start = ragged.ranges(w.first[:-1], n)
    value = np.zeros(len(start), _U)
    for k in range(width):
        inside = start + k < w.first[of + 1]
        part = np.where(inside, word[np.minimum(start + k, max(len(word) - 1, 0))] | _U(1), _U(0)) if len(word) else value
        value = ragged.mix(value + part)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.searchsorted(of[new], np.arange(len(offs)))


def signatures(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set that is not empty: two fingerprints, and the keys' halves (those of the second collection are odd)."""
    some = np.flatnonzero(np.diff(first))
    at = first[:-1][some]
    prints = np.stack([np.add.reduceat(ragged.mix(values ^ _U(s)), at) for s in (0x1F3D, 0x77A5)], axis=1)
    halves = np.empty((len(some), 2 * BANDS), _U)
    low = values.astype(np.uint32)
    for band in range(2 * BANDS):
        key = np.full(len(some), _U(band + 1))
        for s in _SEEDS[band * DEPTH : (band + 1) * DEPTH]:
            minima = np.minimum.reduceat((low ^ np.uint32(int(s) & 0xFFFFFFFF)) * np.uint32(int(s) >> 32 | 1), at)
            key = ragged.mix(key + minima.astype(_U))
        halves[:, band] = key & ~_U(1) if band < BANDS else key | _U(1)
    return some, prints, halves


def _signed(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ragged.slices(batches):
            values, first = shingle_sets(*ragged.flat(rows.column("text")), width)
            n = np.diff(first)
            prints, halves = np.zeros((len(n), 2), np.int64), np.zeros((len(n), 2 * BANDS), np.int64)
            if len(values):
                some, p, h = signatures(values, first)
                prints[some], halves[some] = p.view(np.int64), h.view(np.int64)
            ends = pa.array(np.arange(len(n) + 1) * 2 * BANDS, pa.int32())
            columns = [rows.column("doc_id"), pa.array(n), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.ListArray.from_arrays(ends, pa.array(halves.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "f1", "f2", "halves"])

    return sign


def _candidates(sets: DataFrame) -> DataFrame:
    """Links of documents to the smallest one of each table's key that they share."""
    half = sets.select("doc_id", F.explode("halves").alias("half"))
    shared = half.join(half.groupBy("half").agg(F.count("*").alias("c")).where("c > 1"), "half", "left_semi")
    both = shared.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("half") % 2 == 0, F.col("half"))).alias("a"), F.collect_list(F.when(F.col("half") % 2 != 0, F.col("half"))).alias("b")
    )
    tables = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    keys = both.where("size(a) > 0 AND size(b) > 0").select("doc_id", F.explode(tables).alias("key"))
    least = keys.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    return keys.join(least, "key").where("doc_id <> least").select("doc_id", "least").distinct()


def _sets_of(width: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ragged.slices(batches):
            values, first = shingle_sets(*ragged.flat(rows.column("text")), width)
            raw = ragged.binary(values.view(np.uint8), first * 8)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("cluster"), rows.column("pairs"), raw], names=["doc_id", "cluster", "pairs", "set"])

    return build


def _blocked(members: DataFrame, percent: int) -> DataFrame:
    """Members (doc_id, cluster, n) with the names of all pairs of blocks of their cluster in which they are verified.

    A cluster that fits into a block is one. Else documents are banded by the logarithm of their size, so that linked
    ones lie in the same or in neighbouring bands, and a band is dealt over as many blocks as its shingles fill.
    """
    step = math.log(100 / percent)
    sized = members.withColumn("band", F.floor(F.log("n") / step + 1e-9).cast("int"))
    per_band = sized.groupBy("cluster", "band").agg(F.count("*").alias("c"), F.sum("n").alias("shingles"))
    filled = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    bands = per_band.groupBy("cluster").agg(
        F.sum("c").alias("total"), F.sum("shingles").alias("all_shingles"), F.map_from_entries(F.collect_list(F.struct("band", filled))).alias("blocks")
    )
    rows = sized.join(bands, "cluster")
    own = F.concat_ws("/", "band", F.pmod(F.xxhash64("doc_id"), F.col("blocks")[F.col("band")]).cast("string"))

    def beside(by: int):
        there = F.col("band") + by
        n = F.coalesce(F.col("blocks")[there], F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.concat_ws("/", there, i))

    pair = lambda other: F.concat_ws(":", F.least(F.col("own"), other), F.greatest(F.col("own"), other))
    alone = (F.col("total") <= BLOCK) & (F.col("all_shingles") <= BLOCK_SHINGLES)
    pairs = F.when(alone, F.array(F.lit(""))).otherwise(F.transform(F.concat(beside(-1), beside(0), beside(1)), pair))
    return rows.withColumn("own", own).select("doc_id", "cluster", pairs.alias("pairs"))


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets are linked, as a square of truth values."""
    k = len(sets)
    n = np.array([len(s) for s in sets])
    of, values = np.repeat(np.arange(k), n), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    of, values = of[order], values[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    often = np.diff(np.append(starts, len(values)))
    common = np.zeros((k, k), np.int64)
    # values that few sets have: pairs of neighbours in their lists
    few = np.repeat((often > 1) & (often <= 24), often)
    low_of, low = of[few], values[few]
    for step in range(1, 24):
        same = low[step:] == low[:-step] if step < len(low) else np.zeros(0, bool)
        if not same.any():
            break
        common += np.bincount(low_of[:-step][same] * k + low_of[step:][same], minlength=k * k).reshape(k, k)
    common += common.T
    # values of many sets: products of 0/1 rows
    column = np.repeat(np.cumsum(often > 24) - 1, often)
    many = np.repeat(often > 24, often)
    high_of, high = of[many], column[many]
    for at in range(0, int(high[-1]) + 1 if len(high) else 0, 4096):
        part = (high >= at) & (high < at + 4096)
        rows = np.zeros((k, 4096), np.float32)
        rows[high_of[part], high[part] - at] = 1
        common += (rows @ rows.T).astype(np.int64)
    union = n[:, None] + n[None, :] - common
    found = 100 * common >= percent * union
    found[np.arange(k), np.arange(k)] = True
    return found


def spanning(found: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id and the smallest one that it reaches, where that is another."""
    least = ids.copy()
    while True:
        nxt = np.where(found, least[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (nxt == least).all():
            break
        least = nxt
    other = least != ids
    return ids[other], least[other]


def _verified(percent: int):
    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["doc_id"].to_numpy()
        sets = [np.frombuffer(s.as_buffer(), _U) for s in table["set"].combine_chunks()]
        a, b = spanning(linked_pairs(sets, percent), ids)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return verify


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(texts.mapInArrow(_signed(shingle), "doc_id long, n long, f1 long, f2 long, halves array<long>"), "minhash")
    full = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(full.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n", "halves")).alias("one")).select("f1", "f2", "one.*"), "minhash-sets")
    clusters = components(_candidates(classes))
    clusters = clusters.union(clusters.select("component", "component").distinct()).toDF("doc_id", "cluster")
    members = stored(_blocked(clusters.join(classes.select("doc_id", "n"), "doc_id"), percent), "minhash-members")
    # the texts are far larger than the members and move at any size, in one way
    sets = texts.join(members.hint("shuffle_hash"), "doc_id").mapInArrow(_sets_of(shingle), "doc_id long, cluster long, pairs array<string>, set binary")
    links = sets.select("cluster", F.explode("pairs").alias("pair"), "doc_id", "set").groupBy("cluster", "pair").applyInArrow(_verified(percent), "a long, b long")
    # documents with the same set are linked by their smallest one
    same = full.select("doc_id", "f1", "f2").join(classes.select("f1", "f2", F.col("doc_id").alias("least")), ["f1", "f2"]).where("doc_id <> least").select("doc_id", "least")
    found = components(links.union(same))
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, one row for each id, with their columns."""
    kept = near_duplicates(docs, shingle, percent).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.join(kept, "id", "left_semi").dropDuplicates(["id"]).union(rows.where("id IS NULL"))
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
