"""Ranked lexical search over a term-document grid kept as K2-treaps.

A block is a run of documents of one task with about ``POSTINGS`` different (document, term) pairs. Its grid has a row per
term, the most frequent first, and a column per document, by id; a point is an impact, what one occurrence pattern adds to
a score before the term's weight. The grid is cut in four again and again, down to single points. ``Grid`` keeps only cells
that hold a point, as a bit for each quarter in level order, so that a cell's quarters are found by counting bits, and for
each cell the greatest impact in it, as the difference to the cell around it. Blocks are written as one row each (terms and
their document counts, documents, bits, differences) and are an index that can be searched again. Terms and grids are
compressed by the worker that makes them and opened by the one that uses them: between, Spark holds rows of some MB.

A search sends each item's terms to the blocks that hold them, with weights from the document counts of all blocks. There
the paths of the item's rows go down together over ranges of documents: an entry of the queue is a range with the cell of
each row over it, and its key is the weighted sum of those cells' greatest impacts, which no document of the range exceeds.
The entries with the greatest keys are halved first, some dozens at a time, and those that can't reach the ``k`` best
documents found so far are dropped; at single documents the key is the score. So each block gives its exact best ones, and
the best of all blocks are ranked on Spark.

No item, term or document is collected by the driver: it gets two sums (documents with terms, their terms). A block's task
holds the block and ``ITEMS`` items at most; more items are dealt by hash into several tasks.

Defined results: a null, empty or wordless text has no terms, is not counted in N and found by nothing; an item of that kind
has no rows. Rows that repeat a document are documents of their own, as are those without an id (ties: last); an item_id
that has several rows is asked with the terms of all of them, and one without an id is not asked. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.links import stored
from quayside.session import scratch_path

BEST = 10
POSTINGS = 1 << 19
ITEMS = 1024
_BATCH = 64
_UNFOLDED = 1 << 14
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IN_BYTES = re.compile(_TERM.encode())  # letters beyond ASCII have no other bytes
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    m = 10 + (90 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Grid:
    """A weighted grid of ``rows`` x ``columns`` as a K2-treap. Values are below 2^31.

    Cells of side 2^height, the least that spans all columns, stand first, one for each strip of rows that holds a point;
    quarters follow level by level. ``bits`` has four bits for each cell above the points: (row half, column half) in
    turn. ``drops`` is the greatest value around a cell less its own; of the first cells, 0 less their own.
    """

    def __init__(self, rows: int, columns: int, bits: np.ndarray, drops: np.ndarray, strips: np.ndarray):
        self.columns, self.height = columns, max(columns - 1, 0).bit_length()
        self.bits, self.drops, self.strips = bits, drops, strips
        self.first = np.full((rows >> self.height) + 1, -1, np.int64)
        self.first[strips] = np.arange(len(strips))
        # the cell that each bit stands for
        self.child = np.cumsum(bits, dtype=np.int32)
        self.child += np.int32(len(strips) - 1)
        self.child[~bits] = -1
        parent = (np.flatnonzero(bits) >> 2).astype(np.int32)
        self.most = np.zeros(len(drops) + 1, np.int32)  # the last one stands for no cell
        at, to = 0, len(strips)
        self.most[:to] = -drops[:to]
        for _ in range(self.height):  # a level at a time: the cells above are known
            inner = parent[to - len(strips) :]
            until = to + int(np.searchsorted(inner, np.int32(to)))
            self.most[to:until] = self.most[inner[: until - to]] - drops[to:until]
            at, to = to, until

    @classmethod
    def built(cls, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> Grid:
        return cls(rows, columns, *cls.cut(row, column, value, columns))

    @staticmethod
    def cut(row: np.ndarray, column: np.ndarray, value: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bits, drops and strips of a grid's points."""
        height = max(columns - 1, 0).bit_length()
        code = np.zeros(len(row), np.int64)
        for b in range(height):
            code |= ((row >> b) & 1) << (2 * b + 1) | ((column >> b) & 1) << (2 * b)
        code |= (row >> height) << (2 * height)
        order = np.argsort(code)
        code, most = code[order], value[order].astype(np.int32)
        bits, drops = [], []
        for _ in range(height):
            new = np.concatenate([[True], (code[1:] >> 2) != (code[:-1] >> 2)]) if len(code) else np.zeros(0, bool)
            start = np.flatnonzero(new)
            above = np.maximum.reduceat(most, start) if len(start) else most
            cell = np.cumsum(new) - 1
            four = np.zeros((len(start), 4), bool)
            four[cell, code & 3] = True
            bits.append(four.ravel())
            drops.append(above[cell] - most)
            code, most = code[start] >> 2, above
        drops.append(-most)
        return np.concatenate(bits[::-1] or [np.zeros(0, bool)]), np.concatenate(drops[::-1]), code

    def _quarters(self, cells: np.ndarray, rows: np.ndarray, height: np.ndarray, half: int) -> np.ndarray:
        """Of the cells (entries, rows) at these heights, the quarters on the rows' paths in one half of the columns."""
        at = 4 * cells + 2 * ((rows[None, :] >> (height[:, None] - 1)) & 1) + half
        return np.where(cells >= 0, self.child[np.where(cells >= 0, at, 0)], -1)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k columns with the greatest weighted sums above 0 over ``rows``: (column, sum), equal sums by column."""
        cells = self.first[rows >> self.height][None, :]
        start, height = np.zeros(1, np.int64), np.full(1, self.height)
        key = self.most[cells] @ weights
        found: list[tuple[int, int]] = []
        floor, floor_column = 0, -1  # what an entry has to exceed, or to equal with an earlier column
        while len(key):
            ends = height == 0
            if ends.any():
                found += zip((-key[ends]).tolist(), start[ends].tolist(), strict=True)
                found = sorted(found)[:k]
                if len(found) == k:
                    floor, floor_column = -found[-1][0], found[-1][1]
            kept = ~ends & ((key > floor) | ((key == floor) & (start < floor_column)))
            cells, start, height, key = cells[kept], start[kept], height[kept], key[kept]
            if len(key) > _BATCH:
                first = np.argpartition(-key, _BATCH)
                now, later = first[:_BATCH], first[_BATCH:]
            else:
                now, later = np.arange(len(key)), np.zeros(0, np.int64)
            h = height[now]
            halves = [self._quarters(cells[now], rows, h, half) for half in (0, 1)] if len(now) else [cells[:0]] * 2
            below = np.concatenate([*halves, cells[later]])
            start = np.concatenate([start[now], start[now] + (1 << (h - 1)), start[later]])
            height = np.concatenate([h - 1, h - 1, height[later]])
            key = np.concatenate([self.most[halves[0]] @ weights, self.most[halves[1]] @ weights, key[later]])
            some = key > 0
            cells, start, height, key = below[some], start[some], height[some], key[some]
        return [(column, -score) for score, column in found]


# --- the index

_BLOCK = "block long, documents array<long>, n_terms int, terms binary, terms_size long, n_bits long, grid binary, grid_size long"
_TERMS = [np.uint8, np.int32, np.int32]  # bytes, lengths, document counts
_GRID = [np.uint8, np.int32, np.int32]  # bits, drops, strips


def _packed(arrays: list[np.ndarray], kinds: list[type]) -> tuple[bytes, int]:
    """The arrays as one compressed string, and its size when open."""
    arrays = [a.astype(k, copy=False) for a, k in zip(arrays, kinds, strict=True)]
    return ragged.packed(arrays), sum(a.nbytes + 8 for a in arrays)


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, every = 0, 0
        for rows in ragged.slices(batches):
            n = np.diff(ragged.words(*ragged.flat(rows.column("text")), _APART).first)
            some, every = some + int((n > 0).sum()), every + int(n.sum())
        yield pa.RecordBatch.from_pydict({"some": [some], "every": [every]})

    sums = docs.select("text").mapInArrow(count, "some long, every long").agg(F.sum("some"), F.sum("every")).first()
    return sums[0] or 0, sums[1] or 0


def write_index(docs: DataFrame, path: str, postings: int = POSTINGS) -> int:
    """Writes the blocks of ``docs`` (doc_id, text) below ``path``; returns the number of documents with terms."""
    documents, terms = totals(docs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, piece = TaskContext.get().partitionId(), 0
        names: dict[bytes, int] = {}
        ids, size, kinds, held, counts, n = [], [], [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal piece
            column = np.repeat(np.arange(len(ids)), kinds)
            term, tf = np.concatenate(held).astype(np.int64), np.concatenate(counts).astype(np.int64)
            value = impacts(tf, np.array(size, np.int64)[column], documents, terms)
            # columns by id, rows by the number of documents
            last = np.array([x is None for x in ids])
            by_id = np.lexsort((np.array([x or 0 for x in ids], np.int64), last))
            column = np.argsort(by_id)[column]
            df = np.bincount(term, minlength=len(names))
            by_df = np.argsort(-df, kind="stable")
            bits, drops, strips = Grid.cut(np.argsort(by_df)[term], column, value, len(ids))
            spelled = list(names)
            spelled = [spelled[i] for i in by_df.tolist()]
            terms_in = [np.frombuffer(b"".join(spelled), np.uint8), np.fromiter(map(len, spelled), np.int32, len(spelled)), df[by_df]]
            row = [part << 32 | piece, [ids[i] for i in by_id.tolist()], len(names), *_packed(terms_in, _TERMS)]
            row += [len(bits), *_packed([np.packbits(bits), drops, strips], _GRID)]
            piece += 1
            types = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

        for batch in ragged.slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                found = Counter(_IN_BYTES.findall(text.lower())) if text else None
                if not found:
                    continue
                ids.append(doc)
                size.append(found.total())
                kinds.append(len(found))
                held.append(np.fromiter((names.setdefault(w, len(names)) for w in found), np.int32, len(found)))
                counts.append(np.fromiter(found.values(), np.int32, len(found)))
                n += len(found)
                if n >= postings:
                    yield block()
                    names = {}
                    ids, size, kinds, held, counts, n = [], [], [], [], [], 0
        if n:
            yield block()

    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, _BLOCK).write.option("compression", "zstd").parquet(path)
    return documents


# --- the search


def asked_terms(items: DataFrame) -> DataFrame:
    """item_id and term, each once."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    terms = items.where("item_id IS NOT NULL").select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(f"({_TERM})"))).alias("term"))
    return terms.distinct()


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks' terms, a row for each: block, row, term, df."""
    for batch in batches:
        for block, blob, size in zip(batch.column("block").to_pylist(), batch.column("terms"), batch.column("terms_size").to_pylist(), strict=True):
            data, lengths, counts = ragged.unpacked(blob.as_buffer(), size, _TERMS)
            offs = ragged.offsets(lengths)
            for a in range(0, len(counts), _UNFOLDED):
                z = min(a + _UNFOLDED, len(counts))
                some = pa.Array.from_buffers(pa.large_string(), z - a, [None, pa.py_buffer(offs[a : z + 1] - offs[a]), pa.py_buffer(data[offs[a] : offs[z]])])
                columns = [pa.array(np.full(z - a, block)), pa.array(np.arange(a, z, dtype=np.int32)), some.cast(pa.string()), pa.array(counts[a:z])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "row", "term", "df"])


def _weights(lexicon: DataFrame, documents: int) -> DataFrame:
    """Weight of each term from its documents in all blocks."""
    df = lexicon.groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    return df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight")).where("weight > 0")


def search(spark: SparkSession, path: str, documents: int, items: DataFrame, k: int = BEST) -> DataFrame:
    """Of the index below ``path``, the k best documents of each item: item_id, rank, doc_id, score."""
    index = spark.read.schema(_BLOCK).parquet(path)
    asked = stored(asked_terms(items), "treap-asked")
    lexicon = index.select("block", "terms", "terms_size").mapInArrow(_unfold, "block long, row int, term string, df int")
    lexicon = stored(lexicon.join(asked.select("term").distinct(), "term"), "treap-terms")
    batches = max(1, -(-asked.select("item_id").distinct().count() // ITEMS))
    paths = asked.join(_weights(lexicon, documents), "term").join(lexicon, "term")
    paths = paths.select("block", F.pmod(F.xxhash64("item_id"), F.lit(batches)).alias("batch"), "item_id", "row", "weight")
    kind = items.schema["item_id"].dataType.simpleString()

    def work(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return none
        b = block.slice(0, 1).select(["documents", "n_terms", "n_bits", "grid_size"]).to_pylist()[0]
        bits, drops, strips = ragged.unpacked(block.column("grid")[0].as_buffer(), b["grid_size"], _GRID)
        grid = Grid(b["n_terms"], len(b["documents"]), np.unpackbits(bits, count=b["n_bits"]).view(bool), drops, strips)
        asked = asked.sort_by("item_id")
        items = asked.column("item_id").combine_chunks()
        codes = items.dictionary_encode()
        of, row, weight = codes.indices.to_numpy(), asked.column("row").to_numpy().astype(np.int64), asked.column("weight").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
        out_item, out_doc, out_score = [], [], []
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            for column, score in grid.best(row[a:z], weight[a:z], k):
                out_item.append(a)
                out_doc.append(b["documents"][column])
                out_score.append(score)
        return pa.table({"item_id": items.take(pa.array(out_item, pa.int64())), "doc_id": pa.array(out_doc, pa.int64()), "score": pa.array(out_score, pa.int64())})

    none = pa.table({"item_id": pa.array([], _arrow_type(items.schema["item_id"].dataType)), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    body = index.select("block", "documents", "n_terms", "n_bits", "grid", "grid_size", F.explode(F.expr(f"sequence(0L, {batches - 1}L)")).alias("batch"))
    found = body.groupBy("block", "batch").cogroup(paths.groupBy("block", "batch")).applyInArrow(work, f"item_id {kind}, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, path: str | None = None) -> DataFrame:
    """Writes the index (to a fresh shared folder unless ``path`` is given) and searches it."""
    path = path or scratch_path(docs.sparkSession, "treap-index")
    return search(docs.sparkSession, path, write_index(docs, path), items, k)


def op11_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
