"""Merkle manifest of a dataset: one leaf per row, a tree per language, a root over the languages, a proof per row.

A tree grows by aligned append: ``Witnesses`` takes digests from left to right, at any height whose place is next. A node
that was appended keeps a partial witness, the siblings that came before it; each sibling that is completed later is added
to the witnesses of all nodes still open in its run. A run of ``ARITY`` nodes closes to its parent, which is appended one
height up in the same way. A leaf's proof is the chain of its ancestors' witnesses, so siblings are kept once for a whole
subtree and not once for each leaf below it.

Rows are ordered by ranges and numbered within them, which with the counts of earlier ranges gives each row its place in
its language; ``BLOCK`` consecutive ones are one group, whatever the size of the language. The root of a block, worked out
by one task, is a further append of height ``LEVELS`` to the tree above, which is dealt into blocks itself until one node
is left for each language. The subroots go through the same steps to the root. Then witnesses go down: a block's task takes
the witness of its root and gives out those of its nodes. Only digests are shuffled, never texts or proofs.

Defined results: a null column adds ``-`` to the leaf, an empty text ``0:``. Null is a language of its own and comes first.
Rows without an id come first in their language; rows that repeat an id are ordered by leaf and are leaves of their own;
rows alike in all columns are neighbours, and get one proof each. A lone row of a lone language has no siblings: its proof
is the hash of nothing. An empty table has no manifest. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.links import stored

ARITY = 8
LEVELS = 4
BLOCK = ARITY**LEVELS
_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest_of(parts: bytes) -> bytes:
    return hashlib.sha256(parts).hexdigest().encode()


class Node:
    __slots__ = ("after", "before", "digest", "parent")

    def __init__(self, digest: bytes, before: bytes):
        self.digest, self.before, self.after, self.parent = digest, before, [], None

    def witness(self) -> list[tuple[bytes, bytes]]:
        """What stands left and right of the node in its run, then the same of its ancestors."""
        found, at = [], self
        while at.parent is not None:
            found.append((at.before, b"".join(at.after)))
            at = at.parent
        return found


class Witnesses:
    """A tree that grows by appends; open runs by height, each node of them with its partial witness."""

    def __init__(self):
        self.open: list[list[Node]] = []

    def append(self, digest: bytes, height: int = 0) -> Node:
        """Appends a complete subtree of this height by its digest; nothing may be open below it."""
        self.open.extend([] for _ in range(height + 1 - len(self.open)))
        if any(self.open[:height]):
            raise ValueError("the place of this append is not aligned")
        run = self.open[height]
        node = Node(digest, b"".join(n.digest for n in run))
        for sibling in run:
            sibling.after.append(digest)
        run.append(node)
        if len(run) == ARITY:
            self._close(height)
        return node

    def _close(self, height: int) -> None:
        run, self.open[height] = self.open[height], []
        parent = self.append(digest_of(b"".join(n.digest for n in run)), height + 1)
        for node in run:
            node.parent = parent

    def finish(self, height: int | None = None) -> Node:
        """Closes the runs that are not full, up to one node: of this height, or of the least that holds all."""
        at = 0
        while True:
            alone = len(self.open[at]) == 1 and not any(self.open[at + 1 :])
            if alone and (height is None or at >= height):
                return self.open[at][0]
            if self.open[at]:
                self._close(at)
            at += 1


# --- places


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds part and nth (the row's number among those of its key in this task) to rows that are sorted by key."""
    from pyspark import TaskContext

    part, key, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        nth = []
        for k in batch.column("key").to_pylist():
            n = n + 1 if k == key else 0
            key = k
            nth.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())], names=[*batch.schema.names, "part", "nth"])


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds pos (place within the key, from 0) and n (rows of the key). ``rows`` has a column key that is never null."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(parts, F.col("key"), *order).sortWithinPartitions("key", *order)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    numbered = stored(ranges.mapInArrow(_numbered, f"{ddl}, part int, nth long"), "manifest-places")
    counts = numbered.groupBy("key", "part").agg(F.count("*").alias("m"))
    by_key = Window.partitionBy("key")
    earlier = counts.select("key", "part", (F.sum("m").over(by_key.orderBy("part")) - F.col("m")).alias("earlier"), F.sum("m").over(by_key).alias("n"))
    return numbered.join(earlier, ["key", "part"]).withColumn("pos", F.col("earlier") + F.col("nth")).drop("earlier", "nth", "part")


# --- trees


def _grown(table: pa.Table, height: int) -> tuple[pa.Table, list[Node], Node]:
    """The rows of a block by place, their nodes, and the block's root."""
    table = table.sort_by("pos")
    tree = Witnesses()
    nodes = [tree.append(d.hex().encode(), height) for d in table.column("digest").to_pylist()]
    return table, nodes, tree.finish(height + LEVELS if table.column("n")[0].as_py() > BLOCK else None)


def _up(nodes: DataFrame, height: int) -> DataFrame:
    """Roots of the blocks of ``nodes`` (key, pos, n, digest), which are the nodes of the next step."""

    def root(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1)
        _, _, top = _grown(table, height)
        digest = bytes.fromhex(top.digest.decode())
        n, at = first.column("n")[0].as_py(), first.column("pos")[0].as_py() // BLOCK
        return pa.table({"key": first.column("key"), "pos": [at], "n": [-(-n // BLOCK)], "digest": pa.array([digest], pa.binary())})

    rows = nodes.select("key", "pos", "n", "digest", F.floor(F.col("pos") / BLOCK).alias("block"))
    return stored(rows.groupBy("key", "block").applyInArrow(root, "key string, pos long, n long, digest binary"), "manifest-nodes")


def _down(nodes: DataFrame, height: int, above: DataFrame, give, schema: str) -> DataFrame:
    """``give(rows, witnesses, top)`` for each block; witnesses reach from the node to the root, of which ``above`` (key, pos,
    befores, afters, top) has the part beyond the block."""

    def work(table: pa.Table, above: pa.Table) -> pa.Table:
        table, found, _ = _grown(table, height)
        befores, afters, top = (above.column(c)[0].as_py() for c in ("befores", "afters", "top"))
        beyond = list(zip(befores, afters, strict=True))
        return give(table, [n.witness() + beyond for n in found], top)

    left = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("key", "block")
    right = above.withColumnRenamed("pos", "block").groupBy("key", "block")
    return left.cogroup(right).applyInArrow(work, schema)


def _witness_rows(table: pa.Table, witnesses: list, top: bytes) -> pa.Table:
    sides = [pa.array([[pair[side] for pair in w] for w in witnesses], pa.list_(pa.binary())) for side in (0, 1)]
    return pa.table([table.column("key"), table.column("pos"), *sides, pa.array([top] * len(witnesses), pa.binary())], names=["key", "pos", "befores", "afters", "top"])


_WITNESS = "key string, pos long, befores array<binary>, afters array<binary>, top binary"


def _steps(nodes: DataFrame) -> list[DataFrame]:
    """``nodes``, the roots of its blocks, their blocks' roots, ... up to one node for each key."""
    steps = [nodes]
    while steps[-1].where("n > 1").limit(1).count():
        steps.append(_up(steps[-1], LEVELS * (len(steps) - 1)))
    return steps


def _descended(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """Witnesses of the nodes of ``steps[1]``, from those of the last one."""
    for i in range(len(steps) - 2, 0, -1):
        above = stored(_down(steps[i], LEVELS * i, above, _witness_rows, _WITNESS), "manifest-witnesses")
    return above


def _proofs(table: pa.Table, witnesses: list, top: bytes) -> pa.Table:
    """A block's leaves with their proofs, each folded again from its (tampered) leaf."""
    proofs, folds, root = [], [], top.decode()
    for leaf, changed, witness in zip(table.column("digest").to_pylist(), table.column("changed").to_pylist(), witnesses, strict=True):
        proofs.append(hashlib.sha256(b"".join(side for pair in witness for side in pair)).hexdigest())
        at = (leaf if changed is None else changed).hex().encode()
        for before, after in witness:
            at = digest_of(before + at + after)
        folds.append(at.decode())
    leaves = [d.hex() for d in table.column("digest").to_pylist()]
    values = [leaves, [root] * len(leaves), proofs, folds, [f == root for f in folds]]
    return pa.table([table.column("doc_id"), table.column("key"), *values], names=["doc_id", "key", "leaf", "root", "proof_sha256", "folded_root", "verified"])


# --- the table


def leaf_of(docs: DataFrame, text: Column) -> Column:
    """The leaf of a row, with ``text`` in place of its text."""
    each = [text if c == "text" else F.col(c).cast("string") for c in _COLUMNS]
    field = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in each]
    return F.unhex(F.sha2(F.concat(*field).cast("binary"), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    changed = F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) & (lowered != F.col("text")), leaf_of(docs, lowered))
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(docs, F.col("text")).alias("digest"), changed.alias("changed"), F.monotonically_increasing_id().alias("row"))
    leaves = stored(placed(stored(rows, "manifest-leaves"), [F.col(c) for c in ("doc_id", "digest", "row")]), "manifest-placed")

    steps = _steps(leaves)
    subroots = steps[-1].select(F.col("key").alias("lang_key"), F.col("digest"))
    langs = _steps(stored(placed(subroots.select(F.lit("").alias("key"), "lang_key", "digest"), [F.col("lang_key")]), "manifest-langs"))
    nothing = F.array().cast("array<binary>")
    root = langs[-1].select("key", "pos", nothing.alias("befores"), nothing.alias("afters"), F.lower(F.hex("digest")).cast("binary").alias("top"))
    if len(langs) > 1:
        root = _down(langs[0], 0, _descended(langs, root), _witness_rows, _WITNESS)
    top = root.drop("key").join(langs[0].select("lang_key", "pos"), "pos").select(F.col("lang_key").alias("key"), F.lit(0).cast("long").alias("pos"), "befores", "afters", "top")
    top = stored(top, "manifest-top")

    schema = "doc_id long, key string, leaf string, root string, proof_sha256 string, folded_root string, verified boolean"
    # a language of one row has no tree of its own: its leaf is its subroot, and a block of one all the same
    found = _down(leaves, 0, _descended(steps, top), _proofs, schema)
    names = subroots.select(F.col("lang_key").alias("key"), F.lower(F.hex("digest")).alias("subroot"))
    lang = F.when(F.col("key") != "", F.expr("substr(key, 2)")).alias("lang")
    return found.join(names, "key").select("doc_id", lang, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("lang")
