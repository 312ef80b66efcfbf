"""Suffix-array dedup: bytes of strings of ``WIDTH`` bytes that began earlier are taken out.

Not every suffix is sorted but those that begin at a minimiser: each string of ``WIDTH`` bytes holds one (the lowest
hash of ``GRAM`` bytes in it), at the same place in all its copies, so copies are found from the suffixes that begin
there together with what stands before. Strings that follow each other and have the same minimiser travel as one.

1. Minimisers are counted, and only suffixes whose leading bytes occur again go on. Splitters, sampled from the
   documents, cut their order into ranges by the leading ``GRAM`` bytes. Suffixes with the same ones lie in one range.
2. A range sorts its suffixes by multikey quicksort, eight bytes at a time, only as long as others agree. That bounds how
   far each agrees with any other, and so which strings can have a copy at all.
3. Those are compared whole, by 128-bit hashes, and all but the first of each are marked.

Leading bytes that very many documents share would fill one range; their strings are spread over all ranges by the hash
of the whole string and compared there, across the splitters.

Strings are judged on the input and never cross documents; what is earlier is a smaller doc_id, or an earlier place.
Defined results: a null or empty text has no bytes. Documents without an id come last. Rows that repeat an id are ordered
by a hash of the text; rows alike in both are one document, each answered the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm import repeats as R

WIDTH, GRAM = 100, 16
SLICE = ragged.SLICE // 2
#: Sampled leading bytes for each range.
PER_RANGE = 32

_U = np.uint64


def _runs(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[list[ragged.Rolling], np.ndarray, R.Runs]:
    hashes = [ragged.Rolling(buf, seed) for seed in (1, 2)]
    grams = hashes[0].fixed(GRAM)
    return hashes, grams, R.runs(grams, offs, width, GRAM)


def _anchors(grams: np.ndarray, runs: R.Runs, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each run: the first place of its minimiser, and at how many places it has it."""
    n = runs.windows + width - GRAM
    at = ragged.ranges(runs.start, n)
    of = np.repeat(np.arange(len(n)), n)
    hit = np.flatnonzero(grams[at] == runs.key[of])
    of, at = of[hit], at[hit]
    first = np.searchsorted(of, np.arange(len(n)))
    return at[first] if len(n) else at, np.bincount(of, minlength=len(n))


def _leading(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, GRAM)[at]).view(f"S{GRAM}").ravel() if len(at) else np.zeros(0, f"S{GRAM}")


def _splitters(texts: DataFrame, ranges: int, width: int) -> np.ndarray:
    """Leading bytes that cut a sample of all suffixes into equal parts; at most PER_RANGE for each range are fetched."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ragged.slices(batches, limit=SLICE):
            buf, offs = ragged.flat(rows.column("text"))
            _, grams, runs = _runs(buf, offs, width)
            at, _ = _anchors(grams, runs, width)
            raw = buf.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[a : a + GRAM] for a in at.tolist()], pa.binary()), pa.array(ragged.mix(at.astype(_U) + runs.key).view(np.int64))], names=["lead", "order"])

    sample = texts.where(F.pmod(F.xxhash64("id", "alike"), F.lit(R.SAMPLE)) == 0).mapInArrow(lead, "lead binary, order long")
    rows = sorted(bytes(r["lead"]) for r in sample.orderBy("order").limit(PER_RANGE * ranges).collect())
    step = len(rows) / ranges
    return np.array([rows[int(step * i)] for i in range(1, ranges)] if rows else [], f"S{GRAM}")


def _sent(hot: np.ndarray, splitters: np.ndarray, buckets: int, width: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = R.Outbox(buckets)
        for rows in ragged.slices(batches, limit=SLICE):
            buf, offs = ragged.flat(rows.column("text"))
            hashes, grams, runs = _runs(buf, offs, width)
            base = out.add_docs(rows.column("id").to_numpy(), rows.column("alike").to_numpy())
            runs, doc = R.chosen(runs, offs, rows.column("runs"))
            often = np.isin(runs.key, hot)
            at = ragged.ranges(runs.start[often], runs.windows[often])
            of = np.repeat(np.flatnonzero(often), runs.windows[often])
            out.add_windows(*(h.spans(at, at + width) for h in hashes), base + doc[of], at - offs[doc[of]])
            runs, doc = R.Runs(*(x[~often] for x in runs)), doc[~often]
            anchor, places = _anchors(grams, runs, width)
            bucket = np.searchsorted(splitters, _leading(buf, anchor), "right")
            lengths = runs.windows + width - 1
            place = np.where(places > 1, -1, anchor - runs.start)
            content = buf[ragged.ranges(runs.start, lengths)]
            out.add_runs(bucket, hashes[1].spans(runs.start, runs.start + lengths), runs.key, place, lengths, content, base + doc, runs.start - offs[doc])
            if out.full():
                yield from out.flush()
        yield from out.flush()

    return send


def agreement(buf: np.ndarray, at: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """For each suffix, which begins at ``at``, a bound of how many bytes it agrees in with another one of its group.

    Multikey quicksort: suffixes are sorted by their next eight bytes within what was equal so far, and those that are
    alone drop out.
    """
    padded = np.concatenate([buf, np.zeros(width + 16, np.uint8)])
    bound = np.full(len(at), 7)
    live = np.arange(len(at))
    for depth in range(width // 8 + 1):
        _, group, size = np.unique(group, return_inverse=True, return_counts=True)
        more = size[group] > 1
        live, group = live[more], group[more]
        if not len(live):
            break
        bound[live] = 8 * depth + 7
        bytes_ = np.lib.stride_tricks.sliding_window_view(padded, 8)[at[live] + 8 * depth]
        word = np.ascontiguousarray(bytes_).view(">u8").ravel().astype(_U)
        order = np.lexsort((word, group))
        new = np.ones(len(order), bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (group[order][1:] != group[order][:-1])
        group = np.cumsum(new) - 1
        live = live[order]
    else:
        bound[live] = width + 8
    return bound


def _group(b: R.Bucket, rank: np.ndarray, again: np.ndarray, key: np.ndarray, begins: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Spans of the strings ``again`` of a bucket, which are all of their minimisers."""
    lengths = b.lengths[again].astype(np.int64)
    buf = b.content[ragged.ranges(begins[again], lengths)]
    starts = ragged.offsets(lengths)
    h1, h2 = (ragged.Rolling(buf, seed) for seed in (1, 2))
    grams = h1.fixed(GRAM)
    # every place of a string's minimiser begins a suffix
    string = np.repeat(np.arange(len(again)), lengths)[: len(grams)]
    at = np.flatnonzero(grams == b.key[again][string])
    at = at[at + GRAM <= starts[string[at] + 1]]
    string = string[at]
    bound = agreement(buf, at, key[again][string], width)
    # windows that hold the place, and end where the suffix may still agree with another
    low = np.maximum(at - (width - GRAM), starts[string])
    high = np.minimum(np.minimum(at, starts[string + 1] - width), at + bound - width)
    some = high >= low
    marks = np.zeros(len(buf) + 1, np.int32)
    np.add.at(marks, low[some], 1)
    np.add.at(marks, high[some] + 1, -1)
    window = np.flatnonzero(np.cumsum(marks) > 0)
    string = np.searchsorted(starts, window, "right") - 1
    yield from R.flagged(b, rank, again[string], window - starts[string], h1.spans(window, window + width), h2.spans(window, window + width), width, within=True)


def _compared(width: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in R.by_bucket(batches):
            b = R.Bucket.opened(blobs)
            yield R.single_spans(b, width, within=True)
            rank = np.empty(len(b.of), np.int64)
            rank[np.lexsort((b.pos, b.alike, b.id))] = np.arange(len(b.of))
            # rows alike in id and text are one document
            order = np.argsort(rank)
            same = np.zeros(len(order), bool)
            same[1:] = (b.id[order][1:] == b.id[order][:-1]) & (b.alike[order][1:] == b.alike[order][:-1]) & (b.pos[order][1:] == b.pos[order][:-1])
            rank[order] = np.cumsum(~same)
            yield R.later(b, rank, b.lengths)
            occurrences = np.bincount(b.of, minlength=len(b.key))
            _, key = np.unique(b.key, return_inverse=True)
            again = np.flatnonzero((np.bincount(key, occurrences)[key] > 1) | (b.anchor < 0))
            begins = ragged.offsets(b.lengths)[:-1]
            for some in R.groups(key[again], b.lengths[again]):
                yield from _group(b, rank, again[some], key, begins, width)

    return compare


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in ragged.slices(batches):
        buf, offs = ragged.flat(rows.column("text"))
        raw = buf.tobytes()
        sizes, removed, spans, digests = np.diff(offs), [], [], []
        for i, (starts, ends) in enumerate(zip(rows.column("starts"), rows.column("ends"), strict=True)):
            a, b = R.merged(*(np.asarray(x.values.to_numpy(), np.int64) for x in (starts, ends)))
            text, digest, done = raw[offs[i] : offs[i + 1]], hashlib.sha256(), 0
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                digest.update(text[done:x])
                done = y
            digest.update(text[done:])
            removed.append(int((b - a).sum()))
            spans.append(len(a))
            digests.append(digest.hexdigest())
        columns = [rows.column("doc_id"), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Spans of bytes to remove, a row per document: id and alike (see ``repeats.numbered``), starts, ends."""
    texts = R.numbered(docs)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = R.hot_keys(texts, lambda buf, offs: _runs(buf, offs, width)[2].key)
    splitters = _splitters(texts, 4 * n, width)

    def find(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, R.Runs, np.ndarray]:
        _, grams, runs = _runs(buf, offs, width)
        return offs, runs, _anchors(grams, runs, width)[1] > 1

    some = R.with_runs(texts, R.repeated_runs(texts, find, hot, SLICE))
    parts = some.mapInArrow(_sent(hot, splitters, 4 * n, width), "bucket int, size long, blob binary")
    return R.by_document(R.dealt(parts, n), _compared(width), n)


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return R.with_spans(docs, repeated_spans(docs, width)).mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
