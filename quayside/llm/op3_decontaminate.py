"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items scans each text once.

Words are runs of letters, digits and non-ASCII bytes, with A-Z lower-cased; a window is ``window`` consecutive words
of an item, or the whole item when it has fewer. Each word of a window has a number, which is spelled with a few letters,
as many for every word; a word of a text that is in no window has a spelling that no window has. The automaton reports every
window in a text so spelled, also overlapping ones, and the words it covers are mapped back to where they stand in the
original text. A number's first letter is none of the others, so no match begins inside a word.

Windows are made and freed of repeats on Spark. They travel as broadcasts that ask for about ``block_bytes`` in a worker
at most, the ids of their items included; a window of very many items is in several of them. A larger benchmark is cut into
blocks of that size; each block is one more step over the same rows, without a shuffle, and after ``STEPS`` blocks the rows are
written, so that a task never has more automata than that.

Defined results: a null or empty text has no words and is clean. An item without words, or without an id, has no window.
Items that repeat an id count as one item. Rows that repeat a document are reported once each, whatever their other columns.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.links import stored

WINDOW = 10
BLOCK_BYTES = 64 << 20
#: Bytes a worker needs for a word of a window, for a window, and for the id of an item beside its letters.
WORD_BYTES, WINDOW_BYTES, ID_BYTES = 160, 400, 64
#: Letters of a digit, and where the first digit's and the others' begin.
LETTERS, _FIRST, _NEXT = 64, 0x100, 0x30
#: Blocks that follow one another in a task.
STEPS = 4

#: Bytes between words: all ASCII but letters and digits.
APART = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_PLAIN = bytes(32 if APART[b] else int(ragged.LOWER[b]) for b in range(256))

Block = dict[bytes, list[str]]


class Finder(NamedTuple):
    """The automaton, the spelling of its words, and that of all others."""

    automaton: ahocorasick.Automaton
    spelled: dict[bytes, str]
    other: str


_built: dict[str, Finder] = {}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def windows_of(text: str | None, window: int = WINDOW) -> list[bytes]:
    found = words_of(text)
    every = (b" ".join(found[i : i + window]) for i in range(max(1, len(found) - window + 1)))
    return list(dict.fromkeys(every)) if found else []


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """window, item_id: each pair once, in the order of windows inside a task."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ragged.slices(batches):
            found = [windows_of(t, window) for t in part.column("text").to_pylist()]
            ids = part.column("item_id").take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))
            yield pa.RecordBatch.from_arrays([pa.array([w for x in found for w in x], pa.binary()), ids], names=["window", "item_id"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(make, "window binary, item_id string").distinct().sortWithinPartitions("window", "item_id")


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """Windows with the ids of their items, in blocks of bounded size; the driver holds one block at a time."""
    block: Block = {}
    size = 0
    for w, item in _windows(benchmark, window).toLocalIterator():
        w = bytes(w)
        if w not in block:
            block[w] = []
            size += WINDOW_BYTES + WORD_BYTES * (w.count(b" ") + 1) + len(w)
        block[w].append(item)
        size += ID_BYTES + len(item)
        if size >= block_bytes:
            yield block
            block, size = {}, 0
    if block:
        yield block


class _Sent:
    """A block of items on its way to the workers, with a name that stays the same there."""

    def __init__(self, spark: SparkSession, block: Block):
        self.id, self._block = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

    @property
    def value(self) -> Block:
        return self._block.value


def spelling(words: list[bytes]) -> tuple[dict[bytes, str], str]:
    """A word's number in ``LETTERS`` as the base, all with as many digits; the first digit has letters of its own."""
    width = 1
    while LETTERS**width < len(words):
        width += 1
    digits = [[n // LETTERS**i % LETTERS for i in reversed(range(width))] for n in range(len(words))]
    return {w: "".join([chr(_FIRST + d[0]), *(chr(_NEXT + x) for x in d[1:])]) for w, d in zip(words, digits, strict=True)}, chr(_NEXT - 1) * width


def _finder(sent: _Sent) -> Finder:
    """Built once in each Python worker."""
    if sent.id not in _built:
        _built.clear()
        automaton = ahocorasick.Automaton()
        spelled, other = spelling(list(dict.fromkeys(x for w in sent.value for x in w.split(b" "))))
        for w, items in sent.value.items():
            words = w.split(b" ")
            automaton.add_word("".join([spelled[x] for x in words]), (len(words), items))
        if spelled:
            automaton.make_automaton()
        _built[sent.id] = Finder(automaton, spelled, other)
    return _built[sent.id]


def _matches(words: list[bytes], finder: Finder) -> tuple[list[tuple[int, int]], set[str]]:
    """Covered runs of words [from, to) in the order of their end, and the items found."""
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    if not finder.spelled:
        return runs, items
    width = len(finder.other)
    for end, (n, ids) in finder.automaton.iter("".join(map(finder.spelled.get, words, itertools.repeat(finder.other)))):
        last = (end + 1) // width
        runs.append((last - n, last))
        items.update(ids)
    return runs, items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words as character offsets in the original text."""
    raw = text.encode()
    w = ragged.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), APART)
    out, at, chars = [], 0, 0
    for a, b in runs:
        ends = []
        for to in (int(w.start[a]), int(w.end[b - 1])):
            chars += len(raw[at:to].decode())
            at = to
            ends.append(chars)
        out.append({"start": ends[0], "end": ends[1]})
    return out


_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _replaced(part: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(n, part.column(n)) for n in part.schema.names], names=part.schema.names)


def _scanned(found: DataFrame, sent: _Sent, last: bool) -> DataFrame:
    """Adds to ``hits`` (runs of words) and ``item_ids`` what one block of items finds. After the last block the runs
    become character offsets, in the same step: each step has Python workers of its own."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(sent)
        for part in ragged.slices(batches):
            counts, hits, items = [], [], []
            for text, old_hits, old_items in zip(*(part.column(c).to_pylist() for c in ("text", "hits", "item_ids")), strict=True):
                words = words_of(text)
                runs, ids = _matches(words, finder)
                counts.append(len(words))
                hits.append([*old_hits, *({"start": a, "end": b} for a, b in _merged(runs))])
                items.append(sorted({*old_items, *ids}))
            found = _replaced(part, n_words=pa.array(counts, pa.int64()), hits=pa.array(hits, _HITS), item_ids=pa.array(items, pa.list_(pa.string())))
            yield _finished(found) if last else found

    return found.mapInArrow(scan, found.schema)


def _finished(part: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of words become character offsets; their words are counted once."""
    counts, hits = [], []
    for text, found in zip(part.column("text").to_pylist(), part.column("hits").to_pylist(), strict=True):
        runs = _merged([(r["start"], r["end"]) for r in found])
        counts.append(sum(b - a for a, b in runs))
        hits.append(_spans(text, runs) if runs else [])
    return _replaced(part, n_hit=pa.array(counts, pa.int64()), hits=pa.array(hits, _HITS))


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: text, row (a struct of its other columns), n_words, n_hit (words covered),
    item_ids (sorted), hits (character offsets in the text)."""
    spark = docs.sparkSession
    sent = [_Sent(spark, b) for b in _blocks(benchmark, window, block_bytes)] or [_Sent(spark, {})]
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    zero = F.lit(0).cast("long")
    found = docs.select(
        "text",
        F.struct(*others).alias("row"),
        zero.alias("n_words"),
        zero.alias("n_hit"),
        F.array().cast("array<string>").alias("item_ids"),
        F.array().cast("array<struct<start: long, end: long>>").alias("hits"),
    )
    for i, one in enumerate(sent):
        if i and i % STEPS == 0:
            found = stored(found, "scanned")
        found = _scanned(found, one, i == len(sent) - 1)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with their columns and order of columns.

    A decision needs one row only, so rows are tested where they are and no join brings their columns back.
    """
    kept = marked(docs, benchmark, window, block_bytes).where("n_hit = 0")
    return kept.select(*["text" if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return marked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
