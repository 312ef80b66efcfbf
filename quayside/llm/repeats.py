"""What the two operators on repeated passages share: runs of windows with one minimiser, and taking spans out of texts.

A window is ``width`` consecutive units (words or bytes) of one text; its minimiser is the lowest hash of the ``gram``
consecutive units in it. Windows that follow each other and have the same minimiser form a run, which travels as one
string. Equal windows have equal minimisers, so they meet where their runs do.

First only minimisers travel, eight bytes for each run, and are counted. Then the strings of those runs do whose
minimiser occurs again: in texts that repeat little, few.

A minimiser that very many documents have would bring all its runs to one task. Such ones are found in a sample, and
their windows are dealt one by one by the hash of the whole window instead. Equal strings of one task travel once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import ragged

_U = np.uint64
LAST = 2**63 - 1

#: One document in SAMPLE is looked at for minimisers that very many documents have. That decides where windows are
#: compared, never whether.
SAMPLE, HOT_SHARE, HOT_LEAST = 64, 0.005, 16


class Runs(NamedTuple):
    """Each run's first unit and number of windows, and its minimiser's hash."""

    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray


def runs(grams: np.ndarray, first: np.ndarray, width: int, gram: int) -> Runs:
    """``grams`` has a hash for each unit at which ``gram`` units begin; ``first`` says where each text's units begin and end."""
    lowest = ragged.lowest(grams, width - gram + 1)
    at = ragged.ranges(first[:-1], np.maximum(np.diff(first) - width + 1, 0))
    key = lowest[at]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    new = np.flatnonzero(new)
    return Runs(at[new], np.diff(np.append(new, len(at))), key[new])


def numbered(docs: DataFrame) -> DataFrame:
    """id (null last), alike (hash of the text), text. Rows that agree in the first two have the same text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("alike"), F.coalesce("text", F.lit("")).alias("text"))


def hot_keys(texts: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Minimisers of at least HOT_SHARE of the sampled documents, ascending: at most a document's mean number of runs
    over HOT_SHARE of them, however many documents there are."""
    sample = texts.where(F.pmod(F.xxhash64("id", "alike"), F.lit(SAMPLE)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ragged.slices(batches):
            keys, often = np.unique(keys_of(*ragged.flat(rows.column("text"))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(often), pa.array(np.full(len(keys), 0))], names=["key", "n", "docs"])
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([rows.num_rows])], names=["key", "n", "docs"])

    found = sample.mapInArrow(count, "key long, n long, docs long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(f"n >= {HOT_LEAST} OR docs > 0")
    total, keys = None, []
    for r in found.orderBy(F.col("docs").desc(), F.col("n").desc()).toLocalIterator():
        total = r["docs"] if total is None else total
        if r["n"] >= max(HOT_LEAST, HOT_SHARE * total):
            keys.append(r["key"])
        elif not r["docs"]:  # the row that counts the documents comes first
            break
    return np.sort(np.array(keys, np.int64).view(_U))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def repeated_runs(texts: DataFrame, find: Callable, hot: np.ndarray, limit: int) -> DataFrame:
    """id, alike and the numbers of the document's runs whose minimiser occurs again, or is a hot one.

    ``find`` gives, for bytes and offsets, where each text's units begin, the runs, and which of them hold their minimiser
    more than once. Those, and hot ones, are sent twice, the latter under a key of their own.
    """
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = [_U, np.int32, np.int32, np.int64, np.int64]

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        sizes = np.array([len(x[3]) for x in held])
        before = np.repeat(ragged.offsets(sizes)[:-1], [len(x[0]) for x in held])
        key, doc, run, ids, alikes = (np.concatenate(x) for x in zip(*held, strict=True))
        doc = doc + before
        bucket = (key % _U(4 * n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(4 * n + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            o = order[cut[b] : cut[b + 1]]
            known, number = np.unique(doc[o], return_inverse=True)
            arrays = [key[o], number.astype(np.int32), run[o], ids[known], alikes[known]]
            size = 8 * len(arrays) + sum(a.nbytes for a in arrays)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([size], pa.int64()), pa.array([ragged.packed(arrays)], pa.binary())], names=["bucket", "size", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in ragged.slices(batches, limit=limit):
            first, runs, twice = find(*ragged.flat(rows.column("text")))
            ids, alikes = rows.column("id").to_numpy(), rows.column("alike").to_numpy()
            doc = np.searchsorted(first, runs.start, "right") - 1
            run = np.arange(len(doc)) - np.searchsorted(doc, doc)
            often = np.isin(runs.key, hot)
            own = ragged.mix(runs.key + alikes.view(_U)[doc] + run.astype(_U))
            at = np.concatenate([np.arange(len(doc)), np.flatnonzero(twice | often)])
            held.append((np.where(often, own, runs.key)[at], doc[at], run[at].astype(np.int32), ids, alikes))
            size += len(at)
            if size >= 1 << 20:
                yield from flush(held)
                held, size = [], 0
        yield from flush(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in by_bucket(batches):
            parts, docs = [], 0
            for size, blob in blobs:
                key, doc, run, ids, alikes = ragged.unpacked(blob, size, kinds)
                parts.append((key, doc + docs, run, ids, alikes))
                docs += len(ids)
            key, doc, run, ids, alikes = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, number, often = np.unique(key, return_inverse=True, return_counts=True)
            at = np.flatnonzero(often[number] > 1)
            at = at[np.argsort(doc[at], kind="stable")]
            new = np.flatnonzero(np.append(True, doc[at][1:] != doc[at][:-1])) if len(at) else at
            lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)), pa.int32()), pa.array(run[at]))
            one = doc[at][new]
            yield pa.RecordBatch.from_arrays([pa.array(ids[one]), pa.array(alikes[one]), lists], names=["id", "alike", "runs"])

    parts = texts.mapInArrow(send, "bucket int, size long, blob binary")
    found = dealt(parts, n).mapInArrow(count, "id long, alike long, runs array<int>")
    return found.groupBy("id", "alike").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def with_runs(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """The texts that have such runs, with their numbers. A row that repeats id and text comes along as often."""
    listed = runs.toDF("_id", "_alike", "runs").hint("shuffle_hash")
    return texts.join(listed, (texts["id"] == listed["_id"]) & (texts["alike"] == listed["_alike"])).select("id", "alike", "text", "runs")


def chosen(runs: Runs, first: np.ndarray, lists: pa.Array) -> tuple[Runs, np.ndarray]:
    """The listed runs of the texts of a slice, and the text of each."""
    doc = np.searchsorted(first, runs.start, "right") - 1
    begin = np.searchsorted(doc, np.arange(len(lists)))
    counts = np.diff(lists.offsets.to_numpy())
    picked = np.zeros(len(doc), bool)
    picked[np.repeat(begin, counts) + lists.flatten().to_numpy()] = True
    return Runs(*(x[picked] for x in runs)), doc[picked]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the arrays ``starts`` and ``ends`` of their document's spans (``spans`` has a row for each
    document that has some): doc_id, text, starts, ends."""
    listed = spans.toDF("_id", "_alike", "starts", "ends")
    rows = numbered(docs)
    none = F.array().cast("array<int>")
    both = rows.join(listed.hint("shuffle_hash"), (rows["id"] == listed["_id"]) & (rows["alike"] == listed["_alike"]), "left")
    doc_id: Column = F.when(F.col("id") != LAST, F.col("id"))
    return both.select(doc_id.alias("doc_id"), "text", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"))


def dealt(parts: DataFrame, n: int) -> DataFrame:
    """``parts`` (bucket, size, blob) by bucket over n tasks, the buckets of a task one after the other."""
    return parts.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """The (size, blob) of one bucket at a time."""
    now, held = None, []
    for batch in batches:
        for bucket, size, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "size", "blob")), strict=True):
            if bucket != now and held:
                yield held
                held = []
            now = bucket
            held.append((size, blob))
    if held:
        yield held


#: A blob's arrays. Strings: minimiser, place of the suffix in the string, bytes, number of occurrences. Occurrences:
#: document, first unit. Documents: id, alike. Windows dealt one by one: two hashes, document, first unit.
KINDS = [np.uint64, np.int32, np.int32, np.uint8, np.int32, np.int32, np.int32, np.int64, np.int64, np.uint64, np.uint64, np.int32, np.int32]


class Outbox:
    """Runs of one task on their way to buckets. Equal strings are sent once, with all their occurrences."""

    def __init__(self, buckets: int, limit: int = 16 << 20):
        self.buckets, self.limit = buckets, limit
        self._clear()

    def _clear(self) -> None:
        self.docs, self.strings, self.singles, self.size, self.n = [], [], [], 0, 0

    def add_docs(self, ids: np.ndarray, alikes: np.ndarray) -> int:
        """The number of the first of these documents."""
        self.docs.append((ids, alikes))
        self.n += len(ids)
        return self.n - len(ids)

    def add_runs(self, bucket, same, key, anchor, lengths, content, doc, pos) -> None:
        self.strings.append((bucket, same, key, anchor.astype(np.int32), lengths.astype(np.int32), content, doc.astype(np.int32), pos.astype(np.int32)))
        self.size += len(content) + 40 * len(key)

    def add_windows(self, h1, h2, doc, pos) -> None:
        self.singles.append((h1, h2, doc.astype(np.int32), pos.astype(np.int32)))
        self.size += 24 * len(h1)

    def full(self) -> bool:
        return self.size >= self.limit

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            self._clear()
            return
        ids, alikes = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        bucket, same, key, anchor, lengths, content, doc, pos = (np.concatenate(x) for x in zip(*self.strings, strict=True))
        h1, h2, single_doc, single_pos = (np.concatenate(x) for x in zip(*self.singles, strict=True))
        self._clear()
        starts = ragged.offsets(lengths)[:-1]
        order = np.lexsort((same, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (same[order][1:] != same[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        one = order[new]
        occurrences = np.diff(np.append(np.flatnonzero(new), len(order))).astype(np.int32)
        single_bucket = (h1 % _U(self.buckets)).astype(np.int64)
        single_order = np.argsort(single_bucket, kind="stable")
        cut = np.arange(self.buckets + 1)
        of_string, of_occurrence, of_single = (np.searchsorted(b, cut) for b in (bucket[one], bucket[order], single_bucket[single_order]))
        for b in np.flatnonzero((np.diff(of_occurrence) > 0) | (np.diff(of_single) > 0)).tolist():
            s, o, w = one[of_string[b] : of_string[b + 1]], order[of_occurrence[b] : of_occurrence[b + 1]], single_order[of_single[b] : of_single[b + 1]]
            known, number = np.unique(np.concatenate([doc[o], single_doc[w]]), return_inverse=True)
            number = number.astype(np.int32)
            arrays = [key[s], anchor[s], lengths[s], content[ragged.ranges(starts[s], lengths[s])], occurrences[of_string[b] : of_string[b + 1]], number[: len(o)], pos[o],
                      ids[known], alikes[known], h1[w], h2[w], number[len(o) :], single_pos[w]]
            size = 8 * len(arrays) + sum(a.nbytes for a in arrays)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([size], pa.int64()), pa.array([ragged.packed(arrays)], pa.binary())], names=["bucket", "size", "blob"])


class Bucket(NamedTuple):
    """All blobs of one bucket together; ``of`` is each occurrence's string, documents are given by their id and alike."""

    key: np.ndarray
    anchor: np.ndarray
    lengths: np.ndarray
    content: np.ndarray
    of: np.ndarray
    pos: np.ndarray
    id: np.ndarray
    alike: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    single_id: np.ndarray
    single_alike: np.ndarray
    single_pos: np.ndarray

    @classmethod
    def opened(cls, blobs: list[tuple[int, bytes]]) -> Bucket:
        parts, strings = [], 0
        for size, blob in blobs:
            key, anchor, lengths, content, occurrences, doc, pos, ids, alikes, h1, h2, single_doc, single_pos = ragged.unpacked(blob, size, KINDS)
            of = np.repeat(np.arange(strings, strings + len(key)), occurrences)
            strings += len(key)
            parts.append((key, anchor, lengths, content, of, pos, ids[doc], alikes[doc], h1, h2, ids[single_doc], alikes[single_doc], single_pos))
        return cls(*(np.concatenate(x) for x in zip(*parts, strict=True)))


#: Bytes of a bucket's strings that are compared at a time, unless one minimiser has more.
GROUP = 1 << 20


def groups(key: np.ndarray, lengths: np.ndarray, limit: int = GROUP) -> Iterator[np.ndarray]:
    """Strings in groups of whole minimisers with at most ``limit`` bytes, one minimiser at least. Equal windows have equal
    minimisers, so each group can be compared by itself."""
    order = np.argsort(key, kind="stable")
    ends = np.cumsum(lengths[order], dtype=np.int64)
    edges = np.append(np.flatnonzero(np.diff(key[order])) + 1, len(order))
    at = 0
    while at < len(order):
        before = int(ends[at - 1]) if at else 0
        fit = int(np.searchsorted(ends, before + limit, "right"))
        last = int(np.searchsorted(edges, max(fit, at + 1), "right")) - 1
        to = int(edges[last]) if last >= 0 and edges[last] > at else int(edges[last + 1])
        yield order[at:to]
        at = to


def spans_batch(id_: np.ndarray, alike: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(id_), pa.array(alike), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["id", "alike", "start", "end"])


SPANS = "id long, alike long, start int, end int"
LISTED = "id long, alike long, starts array<int>, ends array<int>"


def listed(spans: DataFrame) -> DataFrame:
    """Spans as rows to a row for each document."""
    return spans.groupBy("id", "alike").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def by_document(parts: DataFrame, compare: Callable, n: int) -> DataFrame:
    """The same from the tasks that compare, which send their spans in one blob for each bucket of documents, those that
    overlap or touch as one: no row for each window."""

    def united(held: list) -> tuple[np.ndarray, ...]:
        """id, alike, number of spans of each document, starts, ends."""
        id_, alike, start, end = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((alike, id_))
        id_, alike = id_[order], alike[order]
        new = np.ones(len(order), bool)
        new[1:] = (id_[1:] != id_[:-1]) | (alike[1:] != alike[:-1])
        first, doc = np.flatnonzero(new), (np.cumsum(new) - 1) << 32
        # the document in the upper half keeps spans of two documents apart
        starts, ends = merged(doc + start[order], doc + end[order])
        counts = np.bincount(starts >> 32, minlength=len(first))
        return id_[first], alike[first], counts.astype(np.int32), (starts & 0xFFFFFFFF).astype(np.int32), (ends & 0xFFFFFFFF).astype(np.int32)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        id_, alike, counts, starts, ends = united(held)
        bucket = (ragged.mix(id_.view(_U) ^ ragged.mix(alike.view(_U))) % _U(2 * n)).astype(np.int64)
        begins = ragged.offsets(counts)[:-1]
        for b in np.unique(bucket).tolist():
            d = np.flatnonzero(bucket == b)
            at = ragged.ranges(begins[d], counts[d])
            arrays = [id_[d], alike[d], counts[d], starts[at], ends[at]]
            size = 8 * len(arrays) + sum(x.nbytes for x in arrays)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([size], pa.int64()), pa.array([ragged.packed(arrays)], pa.binary())], names=["bucket", "size", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in compare(batches):
            if batch.num_rows:
                held.append([batch.column(c).to_numpy() for c in ("id", "alike", "start", "end")])
                size += batch.num_rows
            if size >= 1 << 20:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in by_bucket(batches):
            held = []
            for size, blob in blobs:
                id_, alike, counts, starts, ends = ragged.unpacked(blob, size, [np.int64, np.int64, np.int32, np.int32, np.int32])
                held.append([np.repeat(id_, counts), np.repeat(alike, counts), starts, ends])
            id_, alike, counts, starts, ends = united(held)
            offsets = pa.array(ragged.offsets(counts), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(id_), pa.array(alike), *lists], names=["id", "alike", "starts", "ends"])

    sent = parts.mapInArrow(send, "bucket int, size long, blob binary")
    return dealt(sent, n).mapInArrow(collect, LISTED)


def flagged(b: Bucket, rank: np.ndarray, string: np.ndarray, offset: np.ndarray, h1: np.ndarray, h2: np.ndarray, width: int, within: bool) -> Iterator[pa.RecordBatch]:
    """Spans of units covered by windows that also begin earlier.

    ``string``, ``offset``, h1 and h2 describe windows of the bucket's strings. ``rank`` orders occurrences; the least of
    a string's stands for all of them, since each of the others has every window of the string earlier. With ``within``,
    equal windows in one occurrence, or at one rank, also count as earlier by their place.
    """
    n = len(b.lengths)
    least = np.full(n, LAST)
    np.minimum.at(least, b.of, rank)
    order = np.lexsort((offset, least[string], h2, h1))
    a1, a2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a1[1:] != a1[:-1]) | (a2[1:] != a2[:-1])
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    own, place = least[string][order], offset[order]
    # two strings of one rank and place are one place of one text, sent twice
    again = own > own[heads][group] if len(order) else new
    if within and len(order):
        again |= place > place[heads][group]
    hit = order[again]
    # the least occurrences: runs of hit windows
    key = string[hit] * (int(offset.max()) + 2 if len(offset) else 1) + offset[hit]
    hit = hit[np.argsort(key, kind="stable")]
    s, o = string[hit], offset[hit]
    begin = np.ones(len(hit), bool)
    begin[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1] + 1)
    begin = np.flatnonzero(begin)
    to = np.append(begin[1:] - 1, len(hit) - 1) if len(hit) else begin
    run_string, run_from, run_to = s[begin], o[begin], (o[to] + width if len(hit) else o[begin])
    first_of = np.flatnonzero(rank == least[b.of])
    per_string = np.bincount(run_string, minlength=n)
    run_start = ragged.offsets(per_string)
    occ = np.repeat(first_of, per_string[b.of[first_of]])
    which = ragged.ranges(run_start[b.of[first_of]], per_string[b.of[first_of]])
    yield spans_batch(b.id[occ], b.alike[occ], b.pos[occ] + run_from[which], b.pos[occ] + run_to[which])


def later(b: Bucket, rank: np.ndarray, units: np.ndarray) -> pa.RecordBatch:
    """Occurrences of a string that came earlier: all their units."""
    least = np.full(len(b.lengths), LAST)
    np.minimum.at(least, b.of, rank)
    occ = np.flatnonzero(rank > least[b.of])
    return spans_batch(b.id[occ], b.alike[occ], b.pos[occ], b.pos[occ] + units[b.of[occ]])


def single_spans(b: Bucket, width: int, within: bool) -> pa.RecordBatch:
    """The same for windows that were dealt one by one."""
    order = np.lexsort((b.single_pos, b.single_alike, b.single_id, b.h2, b.h1))
    new = np.ones(len(order), bool)
    new[1:] = (b.h1[order][1:] != b.h1[order][:-1]) | (b.h2[order][1:] != b.h2[order][:-1])
    again = ~new
    heads = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    if within:
        same = (b.single_id[order] == b.single_id[heads]) & (b.single_alike[order] == b.single_alike[heads]) & (b.single_pos[order] == b.single_pos[heads])
        again &= ~same
    else:
        again = b.single_id[order] > b.single_id[heads]
    at = order[again]
    return spans_batch(b.single_id[at], b.single_alike[at], b.single_pos[at], b.single_pos[at] + width)
