"""Approximate nearest neighbours by inner product: a forest of random-projection trees with one queue for all trees.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the greatest norm, and queries a zero there, so that the largest
inner product is the least distance. Each tree has an orthonormal random direction per level and a threshold per node, the
median of a bounded sample (``SAMPLE`` vectors, by a hash of their id) below that node; every row is then sent down all
trees and lies in one cell of each. Trees have about ``CELL`` rows in a cell, and ``SPARSE`` sampled ones at least.

A query's queue holds nodes of all trees, by the squared distance to their half-spaces that is known so far. As directions
are orthogonal that never falls towards the leaves, so the cells come out in the order of their own keys, and the queue is
worked off by whole levels for many queries at once. Cells are taken until they hold ``budget`` rows. The budget is
measured: for ``PROBES`` queries all rows are compared, and the budget is the least at which the queue meets ``TARGET`` of
their true neighbours. Rows without any structure need a large share of the table, clustered ones little.

Cells of a subtree with about ``UNIT`` rows are one unit. Rows meet the queries that visit their unit in groups of at most
about ``GROUP`` rows and ``GROUP`` queries: a unit with more of either, such as a cell of very many near copies, is dealt
by hash into several. Only cells that a query visits are compared for it; the best ``k`` of a unit are compared again pair
by pair in double precision, which gives the score, the order and ties. Of equal vectors only the first k + 1 by id can be
anyone's neighbours; the others are taken out beforehand, though they are queries all the same.

Defined results: rows without an id take no part, nor do vectors that are null, empty, zero, or hold null or non-finite
components. A shorter vector counts as filled up with zeros. Rows that repeat an id and its vector count once; an id with
several vectors has each of them as candidate and query, and its best score counts. Equal scores are ordered by id. With
fewer than k candidates in the cells visited all of them are returned. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.links import stored

NEAREST = 20
TREES = 4
SAMPLE = 32768
SPARSE = 8
CELL = 48
UNIT = 8192
GROUP = 16384
PROBES = 64
TARGET = 0.95
_STEP = 256  # queries that are routed, or compared with a unit, at a time
_PAIRS = 1 << 16
_SEED = 12


class Forest:
    """Directions (dims, levels) and thresholds (2^levels - 1, by level) of each tree, number of rows by cell."""

    def __init__(self, sample: np.ndarray, norm: float, rows: int, trees: int = TREES, cell: int = CELL, sparse: int = SPARSE, unit: int = UNIT):
        self.norm, self.dims = norm, sample.shape[1]
        fine = min(rows // cell, len(sample) // sparse)
        self.levels = max(0, min(fine.bit_length() - 1, 24))
        self.top = max(0, min(self.levels, (rows // unit).bit_length() - 1))
        rng = np.random.default_rng(_SEED)
        wide = self.lifted(sample)
        self.directions, self.thresholds = [], []
        for _ in range(trees):
            turned = rng.normal(size=(wide.shape[1], max(self.levels, 1)))
            if self.levels <= wide.shape[1]:
                turned = np.linalg.qr(turned)[0]
            self.directions.append(np.ascontiguousarray(turned[:, : self.levels] / np.linalg.norm(turned[:, : self.levels], axis=0)))
            self.thresholds.append(self._medians(wide @ self.directions[-1]))
        self.sizes = [np.zeros(1 << self.levels, np.int64) for _ in range(trees)]

    def _medians(self, places: np.ndarray) -> np.ndarray:
        node, found = np.zeros(len(places), np.int64), []
        for level in range(self.levels):
            order = np.lexsort((places[:, level], node))
            count = np.bincount(node, minlength=1 << level)
            middle = np.cumsum(count) - count + count // 2
            cut = np.where(count > 0, places[order, level][np.minimum(middle, len(places) - 1)], 0.0)
            found.append(cut)
            node = 2 * node + (places[:, level] >= cut[node])
        return np.concatenate(found) if found else np.zeros(0)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes all norms equal."""
        return np.hstack([x, np.sqrt(np.maximum(0, self.norm**2 - np.einsum("ij,ij->i", x, x)))[:, None]])

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector in each tree."""
        wide, found = self.lifted(x), []
        for turned, cuts in zip(self.directions, self.thresholds, strict=True):
            places, node = wide @ turned, np.zeros(len(x), np.int64)
            for level in range(self.levels):
                node = 2 * node + (places[:, level] >= cuts[(1 << level) - 1 + node])
            found.append(node)
        return np.stack(found, axis=1)

    def queue(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the cells of all trees (numbered one tree after the other) as they leave the queue, and the
        rows held by all cells up to each."""
        length = np.linalg.norm(x, axis=1, keepdims=True)
        wide = np.hstack([x * (self.norm / length), np.zeros((len(x), 1))])
        keys = []
        for turned, cuts in zip(self.directions, self.thresholds, strict=True):
            places, key = wide @ turned, np.zeros((len(x), 1))
            for level in range(self.levels):
                gap = places[:, level : level + 1] - cuts[(1 << level) - 1 : (2 << level) - 1]
                far = gap * gap
                key = np.stack([key + np.where(gap >= 0, far, 0), key + np.where(gap < 0, far, 0)], axis=2).reshape(len(x), -1)
            keys.append(key)
        order = np.argsort(np.hstack(keys), axis=1, kind="stable")
        return order, np.cumsum(np.concatenate(self.sizes)[order], axis=1)


# --- vectors in Arrow


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of numbers as a matrix, shorter ones filled up with zeros."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offs = a.offsets.to_numpy()
    flat = a.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]] if len(a) else np.zeros(0)
    sizes = np.diff(offs)
    if (sizes == dims).all():
        return flat.reshape(len(a), dims).astype(np.float64)
    out = np.zeros((len(a), dims))
    row = np.repeat(np.arange(len(a)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offs[:-1] - offs[0], sizes)] = flat
    return out


def _steps(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def best_of(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, names: np.ndarray, k: int, seen: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of ``vectors`` for each query but those of its own id: row of the query, id, score. ``seen(from, to)``
    says which vectors each of these queries may be compared with."""
    found = []
    slack = 1e-10 * (np.linalg.norm(vectors, axis=1).max(initial=0) + 1e-300)
    for at in range(0, len(queries), _STEP):
        some = queries[at : at + _STEP]
        rough = some @ vectors.T
        rough[ids[at : at + _STEP, None] == names[None, :]] = -np.inf
        if seen is not None:
            rough[~seen(at, at + len(some))] = -np.inf
        if rough.shape[1] > k:
            least = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k] - slack * np.linalg.norm(some, axis=1)
        else:
            least = np.full(len(some), -np.inf)
        row, col = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
        # one sum per pair, in one order: equal vectors get equal scores wherever they lie
        score = np.concatenate([(some[row[i : i + _PAIRS]] * vectors[col[i : i + _PAIRS]]).sum(axis=1) for i in range(0, len(row), _PAIRS)] or [np.zeros(0)])
        order = np.lexsort((names[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < k
        found.append((row[kept] + at, names[col[kept]], score[kept]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


_BEST = "query_id long, vec_id long, score double"


def _best_rows(ids: np.ndarray, best: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict:
    return {"query_id": pa.array(ids[best[0]], pa.int64()), "vec_id": pa.array(best[1], pa.int64()), "score": pa.array(best[2], pa.float64())}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; a pair that was met in several cells counts once."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# --- the search


def _valid(frame: DataFrame) -> DataFrame:
    """vec_id and vec of the rows that take part, each once."""
    whole = F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return frame.where(F.col("vec_id").isNotNull() & whole & F.exists("vec", lambda x: x != 0)).dropDuplicates(["vec_id", "vec"])


def _first_of_equal(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the first k + 1 by id; the rank filter also runs before the exchange."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).drop("nth")


def _sampled(rows: DataFrame, count: int, most: int, salt: int) -> list:
    """At most ``most`` rows, by a hash of the id, to the driver."""
    share = min(1.0, 1.2 * most / max(count, 1))
    return rows.where(F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("vec_id", F.lit(salt)), "vec_id", "vec").limit(most).collect()


def _wide(rows: list, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        out[i, : len(r["vec"])] = r["vec"]
    return out


def _budget(forest: Forest, probes: list, members: DataFrame, k: int, target: float) -> int:
    """The least number of rows, by cells of the queue, that holds ``target`` of the probes' true neighbours."""
    dims = forest.dims
    x, ids = _wide(probes, dims), np.array([r["vec_id"] for r in probes], np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches, 4096):
            vectors, names = _matrix(batch.column("vec"), dims), batch.column("vec_id").to_numpy()
            row, name, score = best_of(x, ids, vectors, names, k)
            where = {n: i for i, n in enumerate(names.tolist())}
            cells = forest.cells(vectors[[where[n] for n in name.tolist()]])
            out = {"probe": pa.array(row, pa.int64()), **_best_rows(ids, (row, name, score)), "cells": pa.array(cells.tolist(), pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(out)

    found = members.mapInArrow(compare, f"probe long, {_BEST}, cells array<long>")
    order = Window.partitionBy("probe").orderBy(F.col("score").desc(), "vec_id")
    true = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("probe", "cells").collect()
    if not true:
        return 1
    queue, held = forest.queue(x)
    place = np.argsort(queue, axis=1)  # of each cell in the probe's queue
    trees = np.arange(len(forest.sizes)) << forest.levels
    met = sorted(int(held[r["probe"], place[r["probe"], np.array(r["cells"]) + trees].min()]) for r in true)
    return met[max(0, math.ceil(target * len(met)) - 1)]


def neighbours(frame: DataFrame, is_query: Column, k: int = NEAREST, target: float = TARGET, **shape) -> DataFrame:
    """``frame`` has vec_id and embedding; one row per query and neighbour found: query_id, rank, vec_id, score. ``shape``
    overrides the forest's trees, cell, sparse and unit, and ``sample``, ``group`` and ``probes``."""
    spark = frame.sparkSession
    sample, group, probes = shape.pop("sample", SAMPLE), shape.pop("group", GROUP), shape.pop("probes", PROBES)
    rows = stored(_valid(frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))), "forest-rows")
    queries = rows.where(is_query)
    members = stored(_first_of_equal(rows, k), "forest-members")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, dims, norm = members.agg(F.count("*"), F.max(F.size("vec")), F.max(F.sqrt(square))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = Forest(_wide(_sampled(members, n, sample, 1), dims), norm, n, **shape)
    levels, top, trees = forest.levels, forest.top, len(forest.sizes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches, 4096):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.cells(_matrix(batch.column("vec"), dims)).tolist(), pa.list_(pa.int32()))], names=["vec_id", "vec", "cells"])

    kind = members.schema["vec"].dataType.simpleString()
    placed = stored(members.mapInArrow(cells, f"vec_id long, vec {kind}, cells array<int>"), "forest-cells")
    by_cell = placed.select(F.posexplode("cells").alias("tree", "cell")).groupBy("tree", "cell").count().collect()  # at most trees * 2^levels rows
    for r in by_cell:
        forest.sizes[r["tree"]][r["cell"]] = r["count"]
    total = queries.count()
    budget = _budget(forest, _sampled(queries, total, probes, 2), placed, k, target)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches, _STEP):
            x = _matrix(batch.column("vec"), dims)
            order, held = forest.queue(x)
            taken = (held - np.concatenate(forest.sizes)[order]) < budget
            visited = np.zeros(order.shape, bool)
            np.put_along_axis(visited, order, taken, axis=1)
            visited &= np.concatenate(forest.sizes) > 0
            by_unit = visited.reshape(len(x), trees << top, -1)
            row, unit = np.nonzero(by_unit.any(axis=2))
            marks = np.packbits(by_unit[row, unit], axis=1)
            pick = pa.array(row)
            out = [batch.column("vec_id").take(pick), batch.column("vec").take(pick), pa.array(unit, pa.int32()), pa.array([m.tobytes() for m in marks], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["query_id", "vec", "unit", "marks"])

    visits = stored(queries.mapInArrow(route, f"query_id long, vec {kind}, unit int, marks binary"), "forest-visits")
    inner = levels - top
    unit_of = F.expr(f"cast(shiftleft(tree, {top}) + shiftright(cell, {inner}) as int)")
    held = placed.select("vec_id", "vec", F.posexplode("cells").alias("tree", "cell")).select("vec_id", "vec", unit_of.alias("unit"), F.expr(f"cast(cell & {(1 << inner) - 1} as int)").alias("cell"))
    # units are at most trees * 2^top rows
    parts = visits.groupBy("unit").agg(F.ceil(F.count("*") / group).cast("int").alias("sets")).join(
        held.groupBy("unit").agg(F.ceil(F.count("*") / group).cast("int").alias("blocks")), "unit"
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = held.join(F.broadcast(parts), "unit").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("part", every("sets"))
    right = visits.join(F.broadcast(parts), "unit").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("sets")).cast("int")).withColumn("block", every("blocks"))

    def compare(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table(_best_rows(np.zeros(0, np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))))
        rows = rows.sort_by([("cell", "ascending"), ("vec_id", "ascending")])
        cell, names, vectors = rows.column("cell").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("vec"), dims)
        marks = np.unpackbits(np.frombuffer(b"".join(asked.column("marks").to_pylist()), np.uint8).reshape(asked.num_rows, -1), axis=1)[:, : 1 << inner].astype(bool)
        ids = asked.column("query_id").to_numpy()
        return pa.table(_best_rows(ids, best_of(_matrix(asked.column("vec"), dims), ids, vectors, names, k, lambda a, b: marks[a:b][:, cell])))

    keys = ["unit", "block", "part"]
    found = left.select(*keys, "vec_id", "vec", "cell").groupBy(*keys).cogroup(right.select(*keys, "query_id", "vec", "marks").groupBy(*keys)).applyInArrow(compare, _BEST)
    return _ranked(found, k)


def op12_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20."""
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
