"""Substring dedup: words of passages that repeat in a later document are taken out.

Super-k-mers: consecutive windows of ``WIDTH`` words that share a minimiser travel as one string, many of them packed
together, to the minimiser's bucket, if the minimiser occurs again (those are counted first). There their windows are sorted, so that equal
ones stand together and the smallest document that has each is known exactly (windows are compared by 128-bit hashes of
their words). Words covered by a window that a smaller document has too are removed from the document.

Windows are judged on the input. Defined results: a null or empty text has no words. Documents without an id come after
all others and not before each other; rows that repeat an id are not before each other either, and each is answered by its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import ragged
from quayside.llm import repeats as R

WIDTH, GRAM = 13, 3

_U = np.uint64


def _chains(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[ragged.Rolling]:
    """Two independent hashes of any range of words."""
    return [ragged.Rolling(ragged.Rolling(buf, seed).spans(start, end), seed + 10) for seed in (1, 2)]


def _runs(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[ragged.Words, list[ragged.Rolling], R.Runs]:
    w = ragged.words(buf, offs)
    chains = _chains(buf, w.start, w.end)
    return w, chains, R.runs(chains[0].fixed(GRAM), w.first, width, GRAM)


def _sent(hot: np.ndarray, buckets: int, width: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = R.Outbox(buckets)
        for rows in ragged.slices(batches):
            buf, offs = ragged.flat(rows.column("text"))
            w, chains, runs = _runs(buf, offs, width)
            base = out.add_docs(rows.column("id").to_numpy(), rows.column("alike").to_numpy())
            runs, doc = R.chosen(runs, w.first, rows.column("runs"))
            pos = runs.start - w.first[doc]
            often = np.isin(runs.key, hot)
            at = ragged.ranges(runs.start[often], runs.windows[often])
            of = np.repeat(np.flatnonzero(often), runs.windows[often])
            out.add_windows(*(c.spans(at, at + width) for c in chains), base + doc[of], at - w.first[doc[of]])
            r = ~often
            first, last = runs.start[r], runs.start[r] + runs.windows[r] + width - 1
            begin, end = w.start[first], w.end[last - 1] if len(last) else last
            key = runs.key[r]
            content = buf[ragged.ranges(begin, end - begin)]
            out.add_runs((key % _U(buckets)).astype(np.int64), chains[1].spans(first, last), key, np.zeros(len(key)), end - begin, content, base + doc[r], pos[r])
            if out.full():
                yield from out.flush()
        yield from out.flush()

    return send


def _compared(width: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in R.by_bucket(batches):
            b = R.Bucket.opened(blobs)
            yield R.single_spans(b, width, within=False)
            # only strings whose minimiser occurs again
            occurrences = np.bincount(b.of, minlength=len(b.key))
            _, key = np.unique(b.key, return_inverse=True)
            again = np.flatnonzero(np.bincount(key, occurrences)[key] > 1)
            starts = ragged.offsets(b.lengths)[:-1]
            units = np.zeros(len(b.key), np.int64)
            for some in R.groups(key[again], b.lengths[again]):
                group = again[some]
                lengths = b.lengths[group].astype(np.int64)
                buf = b.content[ragged.ranges(starts[group], lengths)]
                w = ragged.words(buf, ragged.offsets(lengths))
                n = np.diff(w.first)
                units[group] = n
                at = ragged.ranges(w.first[:-1], n - width + 1)
                string = np.repeat(np.arange(len(group)), n - width + 1)
                h1, h2 = (c.spans(at, at + width) for c in _chains(buf, w.start, w.end))
                yield from R.flagged(b, b.id, group[string], at - w.first[string], h1, h2, width, within=False)
            yield R.later(b, b.id, units)

    return compare


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in ragged.slices(batches):
        buf, offs = ragged.flat(rows.column("text"))
        w = ragged.words(buf, offs)
        raw = buf.tobytes()
        count, removed, digests = np.diff(w.first), [], []
        for i, (starts, ends) in enumerate(zip(rows.column("starts"), rows.column("ends"), strict=True)):
            a, b = (np.asarray(x.values.to_numpy(), np.int64) for x in (starts, ends))
            gone = np.zeros(count[i] + 1, np.int64)
            np.add.at(gone, a, 1)
            np.add.at(gone, b, -1)
            keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + w.first[i]
            removed.append(int(count[i]) - len(keep))
            digests.append(hashlib.sha256(b" ".join([raw[x:y] for x, y in zip(w.start[keep].tolist(), w.end[keep].tolist(), strict=True)])).hexdigest())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(count), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Spans of words to remove, a row per document: id and alike (see ``repeats.numbered``), starts, ends; they may overlap."""
    texts = R.numbered(docs)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = R.hot_keys(texts, lambda buf, offs: _runs(buf, offs, width)[2].key)

    def find(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, R.Runs, np.ndarray]:
        w, _, runs = _runs(buf, offs, width)
        return w.first, runs, np.zeros(len(runs.key), bool)

    some = R.with_runs(texts, R.repeated_runs(texts, find, hot, ragged.SLICE))
    parts = some.mapInArrow(_sent(hot, 4 * n, width), "bucket int, size long, blob binary")
    return R.listed(R.dealt(parts, n).mapInArrow(_compared(width), R.SPANS))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    return R.with_spans(docs, repeated_spans(docs, width)).mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
