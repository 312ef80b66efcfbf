"""Embedding near-dedup: dual traversal of cover trees gives exact links above a cosine.

On unit vectors a cosine of t is a distance of sqrt(2 - 2t), so links are pairs within a radius. Only vectors of one
label meet.

1. Vectors of one label that are the same become one with a weight.
2. A label with more than ``CELL`` vectors is dealt to cells around pivots (a sample, which decides only where pairs are
   compared): a vector belongs to its nearest pivot, and visits each other cell in which a vector within the radius could
   belong. That is so only where the two distances differ by twice the radius at most, and the cell's covering radius
   reaches that far. A cell with more than ``CELL`` vectors of its own is cut into blocks; all its vectors visit the others.
3. A block builds a cover tree over its own vectors and one over its visitors: levels whose radii halve, each node the
   centre of all below it. Two trees are gone through together; a pair of nodes is dropped when its centres are farther
   apart than the covering radii and the radius allow, counted whole when all below must be linked, and opened else.
   Single vectors are compared by their cosine in double precision.

A block gives each vector's number of links, and a spanning forest of the links, never all pairs. Components follow.

Defined results: vectors that are null, empty, zero or hold a null or a non-finite number, and those with a null label
or of another length, link with nothing. Rows that repeat a vec_id are vectors of their own, which count as links of each
other's where they are linked, and share a component. A vector without an id is kept, without a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.links import components, stored

COSINE = 0.98
CELL = 8192
#: At most so many pivots in all; they are broadcast.
PIVOTS = 2048
LEAF = 24
#: Nodes of a level that are compared at a time.
BATCH = 512
#: Distances are computed to about this; nearer to a bound, pairs are compared one by one.
SLACK = 1e-9
#: And those from inner products, to this; they only drop pairs.
ROUGH = 1e-6


class Node:
    __slots__ = ("centre", "radius", "members", "children")

    def __init__(self, centre: np.ndarray, radius: float, members: np.ndarray, children: list):
        self.centre, self.radius, self.members, self.children = centre, radius, members, children


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, to about ROUGH."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def cover_tree(vectors: np.ndarray, members: np.ndarray | None = None, radius: float = 2.0) -> Node:
    """Children are centres at least half the parent's level apart, which cover all below it within that half."""
    members = np.arange(len(vectors)) if members is None else members
    centre = vectors[members[0]]
    reach = float(np.linalg.norm(vectors[members] - centre, axis=1).max())
    # nearer than ROUGH, gaps() cannot tell vectors apart, and halving would not end
    if len(members) <= LEAF or reach <= ROUGH:
        return Node(centre, reach, members, [])
    half = min(radius, reach) / 2
    centres, owner = np.zeros(0, np.int64), np.zeros(len(members), np.int64)
    for at in range(0, len(members), BATCH):
        batch = members[at : at + BATCH]
        far = np.ones(len(batch), bool)
        if len(centres):
            gap = gaps(vectors[batch], vectors[centres])
            owner[at : at + BATCH] = gap.argmin(axis=1)
            far = gap.min(axis=1) > half
        rest = np.flatnonzero(far)
        among = gaps(vectors[batch[rest]], vectors[batch[rest]])
        new: list[int] = []
        for k, i in enumerate(rest.tolist()):  # each becomes a centre unless an earlier one here covers it
            near = among[k, new] if new else np.zeros(0)
            if len(near) and near.min() <= half:
                owner[at + i] = len(centres) + int(near.argmin())
            else:
                owner[at + i] = len(centres) + len(new)
                new.append(k)
        centres = np.concatenate([centres, batch[rest[new]]])
    order = np.argsort(owner, kind="stable")
    groups = np.split(members[order], np.flatnonzero(np.diff(owner[order])) + 1)
    return Node(centre, reach, members, [cover_tree(vectors, g, half) for g in groups])


class Traversal:
    """Links between the vectors of two trees over one array; with the same tree twice, those within it."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, cosine: float):
        self.vectors, self.weights, self.cosine = vectors, weights, cosine
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        self.found = np.zeros(len(vectors), np.int64)
        self.above = np.arange(len(vectors))

    def top(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return int(i)

    def join(self, members: np.ndarray) -> None:
        tops = {self.top(int(i)) for i in members}
        least = min(tops)
        for t in tops:
            self.above[t] = least

    def within(self, node: Node) -> None:
        """Links inside one node, each vector's own not counted."""
        if 2 * node.radius <= self.radius - SLACK:
            self.found[node.members] += int(self.weights[node.members].sum()) - self.weights[node.members]
            self.join(node.members)
        elif not node.children:
            self.compare(node.members, node.members, True)
        else:
            for child in node.children:
                self.within(child)
            self.cross(node.children, node.children, True)

    def cross(self, left: list[Node], right: list[Node], same: bool) -> None:
        """Pairs of nodes that are near enough; each pair once when the lists are the same."""
        centres, reach = np.stack([b.centre for b in right]), np.array([b.radius for b in right])
        for at in range(0, len(left), BATCH):
            some = left[at : at + BATCH]
            bound = np.array([a.radius for a in some])[:, None] + reach[None, :] + self.radius + ROUGH
            near = gaps(np.stack([a.centre for a in some]), centres) <= bound
            if same:
                near &= np.arange(len(right))[None, :] > at + np.arange(len(some))[:, None]
            for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                self.between(some[i], right[j])

    def between(self, a: Node, b: Node) -> None:
        gap = float(np.linalg.norm(a.centre - b.centre))
        if gap > a.radius + b.radius + self.radius + SLACK:
            return
        if gap + a.radius + b.radius <= self.radius - SLACK:
            self.found[a.members] += int(self.weights[b.members].sum())
            self.found[b.members] += int(self.weights[a.members].sum())
            self.join(np.concatenate([a.members, b.members]))
        elif not a.children and not b.children:
            self.compare(a.members, b.members, False)
        elif a.children and b.children:
            self.cross(a.children, b.children, False)
        elif a.children:
            self.cross(a.children, [b], False)
        else:
            self.cross([a], b.children, False)

    def compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        linked = self.vectors[a] @ self.vectors[b].T >= self.cosine
        if same:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.found[a] += linked @ self.weights[b]
        if not same:
            self.found[b] += linked.T @ self.weights[a]
        for i, row in zip(a, linked, strict=True):
            if row.any():
                self.join(np.append(b[row], i))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one as binary doubles; those that can't be linked go."""
    for rows in batches:
        ids, labels, out = [], [], []
        for i, label, v in zip(rows.column("vec_id").to_pylist(), rows.column("label").to_pylist(), rows.column("embedding"), strict=True):
            x = np.array(v.as_py() or [], np.float64) if v.is_valid and v.values.null_count == 0 else np.zeros(0)
            if not len(x) or not np.isfinite(x).all() or not x.any():
                continue
            x = x / np.abs(x).max()
            ids.append(i)
            labels.append(label)
            out.append((x / np.linalg.norm(x) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(out, pa.binary())], names=["id", "label", "v"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(len(column), -1)


def _pivots(vectors: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """For each label and length with more than CELL vectors, some of them: as many as it has cells' worth, PIVOTS in all."""
    groups = vectors.groupBy("label", "size").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    total = groups.agg(F.sum("n")).first()[0]
    if not total:
        return {}
    wanted = F.least(F.ceil(4 * F.col("n") / CELL), F.greatest(F.lit(1), F.floor(F.col("n") * PIVOTS / total)))
    chance = groups.select("label", "size", (wanted / F.col("n")).alias("share"))
    mixed = F.pmod(F.xxhash64("v", "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = vectors.join(chance, ["label", "size"]).where(mixed < F.col("share")).orderBy(F.xxhash64("v", "id")).limit(2 * PIVOTS).select("label", "size", "v").collect()
    found: dict[tuple[str, int], list] = {}
    for r in sample:
        found.setdefault((r["label"], r["size"]), []).append(np.frombuffer(bytes(r["v"]), np.float64))
    return {k: np.stack(v) for k, v in found.items()}


def _homes(sent):
    """Each vector's cell and its distance to the pivot, below 0 where its label has no pivots."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            cell, gap = np.zeros(rows.num_rows, np.int32), np.full(rows.num_rows, -1.0)
            keys = list(zip(rows.column("label").to_pylist(), rows.column("size").to_pylist(), strict=True))
            for key in set(keys) & sent.value.keys():
                at = np.array([i for i, k in enumerate(keys) if k == key])
                away = np.sqrt(np.maximum(2 - 2 * _matrix(rows.column("v").take(pa.array(at))) @ sent.value[key].T, 0))
                cell[at], gap[at] = away.argmin(axis=1), away.min(axis=1)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell), pa.array(gap)], names=[*rows.schema.names, "cell", "gap"])

    return deal


def _visits(sent, reach, blocks, radius: float):
    """A vector's own place and the places that it visits: label, size, cell, block, own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at, cells, block, own = [], [], [], []
            keys = list(zip(rows.column("label").to_pylist(), rows.column("size").to_pylist(), strict=True))
            home, ids = rows.column("cell").to_numpy(), rows.column("id").to_numpy()
            which = (ragged.mix(ids.view(np.uint64)) >> np.uint64(20)).astype(np.int64)
            near: dict[int, list[int]] = {}
            for key in set(keys) & sent.value.keys():
                mine = np.array([i for i, k in enumerate(keys) if k == key])
                away = np.sqrt(np.maximum(2 - 2 * _matrix(rows.column("v").take(pa.array(mine))) @ sent.value[key].T, 0))
                covering = np.array([reach.value.get((*key, c), -9.0) for c in range(away.shape[1])])
                may = (away <= away.min(axis=1, keepdims=True) + 2 * radius + 1e-6) & (away <= covering + radius + 1e-6)
                for i, row in zip(mine.tolist(), may, strict=True):
                    near[i] = np.flatnonzero(row).tolist()
            for i, key in enumerate(keys):
                for c in {int(home[i]), *near.get(i, ())}:
                    n = blocks.value.get((*key, c), 1)
                    for k in range(n):
                        at.append(i)
                        cells.append(c)
                        block.append(k)
                        own.append(c == home[i] and k == which[i] % n)
            names = ["label", "size", "id", "weight", "v"]
            columns = [rows.column(c).take(pa.array(at, pa.int64())) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.int32()), pa.array(block, pa.int32()), pa.array(own, pa.bool_())], names=[*names, "cell", "block", "own"])

    return deal


def _linked(cosine: float):
    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors, ids = _matrix(table["v"].combine_chunks()), table["id"].to_numpy()
        own = table["own"].to_numpy(zero_copy_only=False)
        run = Traversal(vectors, table["weight"].to_numpy(), cosine)
        mine, visitors = np.flatnonzero(own), np.flatnonzero(~own)
        if len(mine):
            tree = cover_tree(vectors, mine)
            run.within(tree)
            if len(visitors):
                before = run.found[mine].copy()
                run.between(tree, cover_tree(vectors, visitors))
                # a link to a visitor counts at the visitor here, and at the other end where that one visits
                run.found[mine] = before
        tops = np.array([run.top(i) for i in range(len(ids))])
        return pa.table({"id": pa.array(ids), "n": pa.array(run.found), "top": pa.array(ids[tops])})

    return link


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = stored(rows.where("vec_id IS NOT NULL AND label IS NOT NULL").mapInArrow(_units, "id long, label string, v binary"), "units")
    classes = units.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("weight")).withColumn("size", F.length("v"))
    # one vector may stand under several labels or, where an id repeats, twice; ids of classes must be apart
    classes = classes.withColumn("class", F.xxhash64("label", "v", "id"))
    classes = stored(classes.select(F.col("class").alias("id"), F.col("id").alias("least"), "label", "size", "v", "weight"), "vector-classes")
    pivots = spark.sparkContext.broadcast(_pivots(classes))
    homes = stored(classes.mapInArrow(_homes(pivots), "id long, least long, label string, size int, v binary, weight long, cell int, gap double"), "cells")
    # an entry for each pivot, and for each other label of more than CELL vectors
    facts = homes.groupBy("label", "size", "cell").agg(F.count("*").alias("n"), F.max("gap").alias("reach"))
    large = facts.where(F.col("n") > CELL).collect()
    reach = {(r["label"], r["size"], r["cell"]): r["reach"] for r in facts.where("reach >= 0").collect()}
    sent_reach = spark.sparkContext.broadcast(reach)
    sent_blocks = spark.sparkContext.broadcast({(r["label"], r["size"], r["cell"]): -(-r["n"] // CELL) for r in large})
    placed = homes.mapInArrow(_visits(pivots, sent_reach, sent_blocks, radius), "label string, size int, id long, weight long, v binary, cell int, block int, own boolean")
    found = stored(placed.groupBy("label", "size", "cell", "block").applyInArrow(_linked(cosine), "id long, n long, top long"), "vector-links")
    links = classes.select("id", "least", "label", "v", "weight").join(found.groupBy("id").agg(F.sum("n").alias("n")), "id")
    # links of classes as links of their smallest vectors
    least = classes.select("id", "least")
    tops = found.where("id <> top").select("id", "top").join(least, "id").join(least.select(F.col("id").alias("top"), F.col("least").alias("to")), "top").select("least", "to")
    members = units.select("label", "v", F.col("id").alias("vec_id")).join(links, ["label", "v"])
    same = members.where("vec_id <> least").select("vec_id", "least")
    joined = components(tops.union(same).toDF("a", "b")).withColumnRenamed("node", "vec_id")
    counted = members.groupBy("vec_id").agg(F.first(F.col("n") + F.col("weight") - 1).alias("n_links"), F.count("*").alias("times"))
    out = rows.select("vec_id").join(counted, "vec_id", "left").join(joined, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
