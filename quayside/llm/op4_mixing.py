"""Language-model scoring by logistic context mixing.

A text is predicted byte by byte and bit by bit. ``ORDERS`` predictors look up how often a bit was 0 or 1 after the last 1,
2, 3, 4 or 6 bytes of the text, whatever words these belong to, and one more after the word so far (its last 6 bytes). Their logits
are combined by weights that a gate (how much three of the predictors have seen) selects; the weights are learned online,
batch by batch, from the prediction errors. An adaptive map then refines the probability by what came true at it. While
weights and map are learned, a byte is taken out of its own counts. After each byte a text ends with one probability, the
training share of ends. The probabilities of all texts add up to one; a text's score is the log10 of its own.

All that a prediction needs is the byte and the six before it: an event. Equal events have equal predictions, so different events are counted, learned from (with their count as weight) and scored once. They are grouped on
Spark by the four bytes before, so that all events of a context of four bytes or more lie in one pack, where the counts of all
its nodes are exact: no table of a fixed size, no collisions. Counts are 64-bit numbers. Tasks send their events in boxes, as many
as the texts' bytes ask for, so that what a task opens at a time does not grow with the corpus.

What goes to all tasks: counts after contexts of fewer than four bytes, weights, and the at most ``FREQUENT`` most frequent
words and ``EVENTS`` times as many most frequent events with their scores. All others of a document meet their scores in a join.

``base_score`` is that of a bare count model of words, for comparison: lower case, an end to each text, add one half.

Defined results: a null or empty text is the end only and has no bits per byte. Without training text the predictors know
nothing (each bit 1/2), and known counts are 0. Rows that repeat a document are scored as rows of their own. A document
without an id is trained on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.links import stored
from quayside.llm.repeats import by_bucket, dealt

FOLDS, HELD_OUT = 5, 1
ORDERS = (1, 2, 3, 4, 6)
LONGEST = max(ORDERS)
PREDICTORS = len(ORDERS) + 1  # the last one's context is the word so far
NEAR = 4  # events are grouped by so many bytes before
GATES = 64
STEPS = 33  # of the adaptive map, for each bit of a byte
ROUNDS, RATE = 1, 0.1
FREQUENT, EVENTS = 200_000, 16
CHUNK = 1 << 13  # events at a time: a step of online learning
MOST = 1 << 20  # different events that a task holds before it gives them on
BUCKET = 1 << 22  # bytes of all texts for each bucket of events
ROWS = 1 << 16

_U = np.uint64
_HIGH = _U(1 << 63)


class Counts(NamedTuple):
    """Of training texts: words, different ones, texts, bytes."""

    tokens: int
    types: int
    texts: int
    bytes: int

    @property
    def all_tokens(self) -> int:
        return self.tokens + self.texts

    def base(self, c: np.ndarray) -> np.ndarray:
        kinds = self.types + (self.texts > 0)
        return np.log10((c + 0.5) / (self.all_tokens + 0.5 * (kinds + 1)))

    @property
    def end(self) -> float:
        """Probability that a text ends where a byte could follow."""
        return (self.texts + 0.5) / (self.bytes + self.texts + 1)


class Spelling(NamedTuple):
    """Counts of each context's nodes, the mixer's weights, and the adaptive map."""

    zeros: np.ndarray
    ones: np.ndarray
    weights: np.ndarray
    came_true: np.ndarray
    logits: np.ndarray | None = None
    seen: np.ndarray | None = None

    @classmethod
    def empty(cls) -> Spelling:
        """Knows one context for each predictor, in which nothing was seen."""
        size = PREDICTORS << 8
        return cls(np.zeros(size), np.zeros(size), np.full((GATES, PREDICTORS + 1), [*[1.5 / PREDICTORS] * PREDICTORS, 0.0]), np.zeros((2, 8, STEPS)))

    def prepared(self, learning: bool) -> Spelling:
        """With each node's logit and how much it has seen, as many events share a node. When learning, these are there twice:
        with a 0 taken out of the counts, then with a 1 taken out."""
        n0, n1 = self.zeros, self.ones
        if learning:
            n0, n1 = np.concatenate([np.maximum(n0 - 1, 0), n0]), np.concatenate([n1, np.maximum(n1 - 1, 0)])
        return self._replace(logits=np.clip(np.log((n1 + 0.1) / (n0 + 0.1)), -9, 9), seen=np.minimum(np.log2(n0 + n1 + 1) / 2, 3).astype(np.int8))

    def mixed(self, places: np.ndarray, bit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, gate and logit of a 1. With ``bit``, each event is taken out of its own counts."""
        now = self if self.logits is not None else self.prepared(bit is not None)
        if bit is not None:
            places = places + bit * np.int64(len(self.zeros))
        inputs = np.empty((PREDICTORS + 1, places.shape[1]))
        inputs[:-1] = now.logits[places]
        inputs[-1] = 0.3
        gate = now.seen[places[-1]] * 16 + now.seen[places[-2]] * 4 + now.seen[places[2]]
        logit = np.clip((np.take(self.weights.T, gate, axis=1) * inputs).sum(axis=0), -14, 14)
        return inputs, gate, logit

    def refined(self, logit: np.ndarray, k: int) -> np.ndarray:
        """The probability of a 1, the mean of the mixer's and of the map's between its two nearest steps."""
        p = 1 / (1 + np.exp(-logit))
        n, hits = self.came_true[0, k], self.came_true[1, k]
        steps = 1 / (1 + np.exp(-np.linspace(-14, 14, STEPS)))
        rate = (hits + 8 * steps) / (n + 8)
        return np.clip(0.5 * p + 0.5 * np.interp(logit, np.linspace(-14, 14, STEPS), rate), 1e-6, 1 - 1e-6)


def grams(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Of each byte of texts all that its contexts need: the byte (lowest), the 6 before it in its text, how many there are (highest)."""
    place = ragged.ranges(np.zeros(len(offs) - 1, np.int64), np.diff(offs))
    gram = buf.astype(_U)
    for back in range(1, min(LONGEST, len(buf) - 1) + 1):
        gram[back:] |= np.where(place[back:] >= back, buf[:-back].astype(_U) << _U(8 * back), _U(0))
    return gram | (np.minimum(place, LONGEST).astype(_U) << _U(56))


def contexts(gram: np.ndarray) -> np.ndarray:
    """A number for each predictor's context, the same for the same bytes. Those of fewer than NEAR bytes are below 2^48."""
    past, place = (gram >> _U(8)) & _U((1 << 48) - 1), gram >> _U(56)
    # the bytes of the word before, which are the last LONGEST where it has more
    size = place.astype(np.int64)
    for back in range(LONGEST, 0, -1):
        size = np.where((place >= _U(back)) & ragged.SPACE[((past >> _U(8 * back - 8)) & _U(255)).astype(np.uint8)], back - 1, size)
    out = np.empty((PREDICTORS, len(gram)), _U)
    for i, width in enumerate([*(np.minimum(place, _U(order)) for order in ORDERS), size.astype(_U)]):
        bytes_ = past & ((_U(1) << (_U(8) * width)) - _U(1))
        out[i] = bytes_ | np.where(width < _U(NEAR), width << _U(40) | _U(i << 43), width << _U(48) | _U(i << 59) | _HIGH)
    return out


def numbered(context: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each context's number among the different ones of all predictors, and those of each predictor."""
    numbers, different, at = np.empty(context.shape, np.int64), [], 0
    for i, one in enumerate(context):
        values, inverse = np.unique(one, return_inverse=True)
        numbers[i] = inverse + at
        different.append(values)
        at += len(values)
    return numbers, different


def events(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: the bytes, the text of each, and the number of each predictor's context."""
    return buf, np.repeat(np.arange(len(offs) - 1), np.diff(offs)), numbered(contexts(grams(buf, offs)))[0]


def bits(spelled: np.ndarray, context: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of a byte's bits, the highest first: its number, the place of each context's node, the bits. ``context`` has
    numbers of contexts, whose nodes are 256 places each, or the places of :func:`known` by bit."""
    for k in range(8):
        if context.ndim == 3:
            places = context[k]
        else:
            places = (context << 8) | (1 << k) | (spelled.astype(np.int64) >> (8 - k))
        yield k, places, (spelled >> (7 - k)) & 1


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The different events of a task's texts, sorted, some millions at a time: how often in training texts, and in all."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        gram, n, f = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(gram)
        gram = gram[order]
        first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]))
        return gram[first], *(np.add.reduceat(x[order], first).astype(np.uint32) for x in (n, f))

    def different(gram: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, ...]:
        key = np.sort((gram << _U(1)) | train)
        gram = key >> _U(1)
        first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]))
        return gram[first], np.add.reduceat((key & _U(1)).astype(np.uint32), first), np.diff(first, append=len(key)).astype(np.uint32)

    kept: list[tuple[np.ndarray, ...]] = []
    size = least = 0
    for rows in ragged.slices(batches):
        buf, offs = ragged.flat(rows.column("text"))
        if not len(buf):
            continue
        train = np.repeat(~rows.column("held_out").to_numpy(zero_copy_only=False), np.diff(offs))
        kept.append(different(grams(buf, offs), train))
        size += len(kept[-1][0])
        if size > least + MOST // 2:
            kept = [merged(kept)]
            size = least = len(kept[0][0])
            if size > MOST:
                yield kept[0]
                kept, size, least = [], 0, 0
    if kept:
        yield merged(kept)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same as rows."""
    for part in _flushes(batches):
        for at in range(0, len(part[0]), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + ROWS].astype(np.int64)) for x in part], names=["gram", "n", "f"])


def boxed(buckets: int):
    """Different events of a task as one blob for each bucket of ``near``: sorted, byte by byte, which packs well."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, f in _flushes(batches):
            group = near(gram)
            bucket = (ragged.mix(group) % _U(buckets)).astype(np.int64)
            order = np.lexsort((gram, group, bucket))
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            del group, bucket
            full = np.flatnonzero(np.diff(cut))
            for at in range(0, len(full), 256):
                some = full[at : at + 256].tolist()
                each = [order[cut[b] : cut[b + 1]] for b in some]
                blobs = [_squeezed(gram[o], n[o], f[o]) for o in each]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([len(o) for o in each], pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "size", "blob"])

    return send


def _squeezed(*arrays: np.ndarray) -> bytes:
    planes = [x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _opened(size: int, blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=16 * size, codec="zstd", asbytes=True), np.uint8)
    cuts = (0, 8 * size, 12 * size, 16 * size)
    kinds = (_U, np.uint32, np.uint32)
    return [np.ascontiguousarray(raw[a:b].reshape(-1, size).T).view(kind).ravel() for a, b, kind in zip(cuts, cuts[1:], kinds, strict=False)]


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs by bucket to packs: equal events of all tasks become one, with 64-bit counts."""
    for blobs in by_bucket(batches):
        gram, n, f = (np.concatenate(x) for x in zip(*(_opened(*x) for x in blobs), strict=True))
        order = np.lexsort((gram, near(gram)))
        gram = gram[order]
        first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]))
        sums = [np.add.reduceat(x[order].astype(np.int64), first) for x in (n, f)]
        yield from packs(iter([pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (gram[first], *sums)], names=["gram", "n", "f"])]))


def near(gram: np.ndarray) -> np.ndarray:
    """The NEAR bytes before; as ``_NEAR`` in Spark."""
    return ((gram >> _U(8)) & _U((1 << 8 * NEAR) - 1)) | (np.minimum(gram >> _U(56), _U(NEAR)) << _U(8 * NEAR))


_NEAR = f"(shiftrightunsigned(gram, 8) & {(1 << 8 * NEAR) - 1}L) | shiftleft(least(shiftrightunsigned(gram, 56), {NEAR}L), {8 * NEAR})"


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by ``near`` as rows of about CHUNK; those after the same NEAR bytes share a row."""
    wait: list[np.ndarray] = []

    def rows_of(part: np.ndarray, last: bool) -> tuple[list[bytes], np.ndarray]:
        alike = near(part[0].view(_U))
        starts = np.flatnonzero(np.diff(alike, prepend=~alike[:1]))
        ends = np.append(starts[1:], part.shape[1]) if last else starts[1:]
        blobs, at = [], 0
        for end in ends.tolist():
            if end - at >= CHUNK or (last and end == part.shape[1]):
                blobs.append(part[:, at:end])
                at = end
        return [(x.shape[1], ragged.packed(list(x))) for x in blobs], part[:, at:]

    def batch_of(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["size", "part"])

    for batch in batches:
        wait.append(np.stack([batch.column(c).to_numpy() for c in ("gram", "n", "f")]))
        if sum(x.shape[1] for x in wait) >= 4 * CHUNK:
            rows, rest = rows_of(np.hstack(wait), False)
            wait = [rest]
            yield batch_of(rows)
    if wait and (part := np.hstack(wait)).shape[1]:
        yield batch_of(rows_of(part, True)[0])


class Pack(NamedTuple):
    gram: np.ndarray
    n: np.ndarray
    f: np.ndarray

    @property
    def byte(self) -> np.ndarray:
        return self.gram.astype(np.uint8)

    def train(self) -> Pack:
        return Pack(*(x[self.n > 0] for x in self))


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
    for batch in batches:
        for size, part in zip(batch.column("size").to_pylist(), batch.column("part").to_pylist(), strict=True):
            yield Pack(*ragged.unpacked(part, 24 + 24 * size, [_U, np.int64, np.int64]))


class Short(NamedTuple):
    """How often each byte came after each context of fewer than NEAR bytes, sorted by context and byte."""

    keys: np.ndarray
    n: np.ndarray


def _short(events: DataFrame) -> Short:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _packs(batches):
            pack = pack.train()
            context = contexts(pack.gram)
            mine = context < _U(1 << 48)
            keys = ((context << _U(8)) | pack.byte)[mine]
            values, inverse = np.unique(keys, return_inverse=True)
            n = np.zeros(len(values), np.int64)
            np.add.at(n, inverse, np.broadcast_to(pack.n, mine.shape)[mine])
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["key", "n"])

    found = events.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, n = found["key"].to_numpy().view(_U), found["n"].to_numpy()
    order = np.argsort(keys)
    return Short(keys[order], n[order])


def known(pack: Pack, short: Short, model: Spelling) -> tuple[np.ndarray, Spelling]:
    """The places of the nodes on the way of each event, by bit and predictor, and the model with their exact counts.

    For each predictor all (context, byte) are sorted, those of the events and those ``short`` has. The nodes of a bit are
    then runs of equal leading bits, so only nodes that an event reaches, or its siblings, take space.
    """
    places, zeros, ones, at = np.empty((8, PREDICTORS, len(pack.gram)), np.int32), [], [], 0
    byte, here = pack.byte, np.arange(len(pack.gram))
    for i, context in enumerate(contexts(pack.gram)):
        values, number = np.unique(context, return_inverse=True)
        few = values[: np.searchsorted(values, _U(1 << 48))]  # counts of these lie in other packs, too
        low, high = np.searchsorted(short.keys, few << _U(8)), np.searchsorted(short.keys, (few + _U(1)) << _U(8))
        entry = ragged.ranges(low, high - low)
        key = np.concatenate([(number << 8) | byte, (np.repeat(np.arange(len(few)), high - low) << 8) | short.keys[entry].astype(np.uint8)])
        n = np.concatenate([np.where(number >= len(few), pack.n, 0), short.n[entry]])
        order = np.argsort(key)
        key, n = key[order], n[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        back = back[here]
        for k in range(8):
            node = key >> (8 - k)
            new = np.ones(len(node), bool)
            new[1:] = node[1:] != node[:-1]
            start = np.flatnonzero(new)
            one = np.add.reduceat(n * ((key >> (7 - k)) & 1), start) if len(start) else start
            zeros.append((np.add.reduceat(n, start) if len(start) else start) - one)
            ones.append(one)
            places[k, i] = (np.cumsum(new) - 1 + at)[back]
            at += len(start)
    return places, model._replace(zeros=np.concatenate(zeros).astype(np.float64), ones=np.concatenate(ones).astype(np.float64))


def _numbered(values: np.ndarray) -> pa.RecordBatch:
    flat = values.ravel()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat.astype(np.float64))], names=["i", "v"])


def _summed(rows: DataFrame, f, n: int) -> np.ndarray:
    """The sums of the n numbers that each task gives."""
    out = np.zeros(n)
    for row in rows.mapInArrow(f, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row["i"]] = row["v"]
    return out


def _round(events: DataFrame, short, model: Spelling) -> np.ndarray:
    """One pass of online learning in every task from the same weights; their mean by the number of events at each gate."""
    width = PREDICTORS + 1

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, past, mass = model.weights.copy(), np.full((GATES, width), 1e-4), np.zeros(GATES)
        for pack in _packs(batches):
            pack = pack.train()
            numbers, now = known(pack, short.value, model)
            now = now.prepared(learning=True)
            for k, places, bit in bits(pack.byte, numbers):
                inputs, gate, logit = now._replace(weights=weights).mixed(places, bit)
                error = (1 / (1 + np.exp(-logit)) - bit) * pack.n
                n = np.bincount(gate, pack.n, GATES)
                slope = np.stack([np.bincount(gate, error * x, GATES) for x in inputs], axis=1) / np.maximum(n, 1)[:, None]
                past += slope**2
                weights = weights - RATE * slope / np.sqrt(past)
                mass += n
        yield _numbered(np.concatenate([(weights * mass[:, None]).ravel(), mass]))

    sums = _summed(events, learn, GATES * width + GATES)
    mass = sums[GATES * width :]
    mean = sums[: GATES * width].reshape(GATES, width) / np.maximum(mass, 1)[:, None]
    return np.where(mass[:, None] > 0, mean, model.weights)


def _map(events: DataFrame, short, model: Spelling) -> np.ndarray:
    """How often what the mixer says came true, by bit and by step of its logit."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 8, STEPS))
        for pack in _packs(batches):
            pack = pack.train()
            numbers, now = known(pack, short.value, model)
            now = now.prepared(learning=True)
            for k, places, bit in bits(pack.byte, numbers):
                step = np.rint((now.mixed(places, bit)[2] + 14) / 28 * (STEPS - 1)).astype(np.int64)
                total[0, k] += np.bincount(step, pack.n, STEPS)
                total[1, k] += np.bincount(step, pack.n * bit, STEPS)
        yield _numbered(total)

    return _summed(events, count, 2 * 8 * STEPS).reshape(2, 8, STEPS)


def fit(events: DataFrame, short) -> Spelling:
    model = Spelling.empty()
    for _ in range(ROUNDS):
        model = model._replace(weights=_round(events, short, model))
    return model._replace(came_true=_map(events, short, model))


def _scored_events(events: DataFrame, short, model: Spelling) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _packs(batches):
            numbers, now = known(pack, short.value, model)
            now = now.prepared(learning=False)
            total = np.zeros(len(pack.gram))
            for k, places, bit in bits(pack.byte, numbers):
                p = now.refined(now.mixed(places)[2], k)
                total += np.log10(np.where(bit == 1, p, 1 - p))
            yield pa.RecordBatch.from_arrays([pa.array(ragged.mix(pack.gram).view(np.int64)), pa.array(pack.f), pa.array(total)], names=["key", "f", "lp"])

    return events.mapInArrow(score, "key long, f long, lp double")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words of a few texts by their hash: how often each is in training texts, and in all texts."""
    for rows in ragged.slices(batches):
        buf, offs = ragged.flat(rows.column("text"))
        buf = ragged.LOWER[buf]
        w = ragged.words(buf, offs)
        words, number = np.unique(word_key(buf, w), return_inverse=True)
        train = np.repeat(~rows.column("held_out").to_numpy(zero_copy_only=False), np.diff(w.first))
        c = np.bincount(number[train], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(c), pa.array(np.bincount(number, minlength=len(words)))], names=["key", "c", "f"])


def word_key(buf: np.ndarray, w: ragged.Words) -> np.ndarray:
    return ragged.mix(ragged.Rolling(buf).spans(w.start, w.end) ^ _HIGH)


class Frequent(NamedTuple):
    """Keys that :func:`ragged.mix` has spread, sorted, and their values. ``starts``: how many keys lie below each of their leading bits."""

    keys: np.ndarray
    values: tuple[np.ndarray, ...]
    least: int
    starts: np.ndarray | None = None

    def opened(self) -> Frequent:
        """Ready for :meth:`places`: with ``starts``, about one for each key."""
        width = max(len(self.keys).bit_length(), 1)
        starts = np.zeros((1 << width) + 1, np.int32)
        for at in range(0, len(self.keys), ROWS):
            lead = (self.keys[at : at + ROWS] >> _U(64 - width)).astype(np.int64)
            starts[lead[0] + 1 : lead[-1] + 2] += np.bincount(lead - lead[0]).astype(np.int32)
        return self._replace(starts=np.cumsum(starts, dtype=np.int32, out=starts))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys are, and whether they are there. Each is looked up from where its leading bits begin, so they need no order."""
        last, width = len(self.keys) - 1, (len(self.starts) - 1).bit_length() - 1
        if last < 0:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(self.starts[(keys >> _U(64 - width)).astype(np.int64)], last)
        found = self.keys[at]
        below = np.flatnonzero((found < keys) & (at < last))
        while len(below):
            at[below] += 1
            found[below] = now = self.keys[at[below]]
            below = below[(now < keys[below]) & (at[below] < last)]
        return at, found == keys


def _frequent(table: DataFrame, most: int, columns: list[str]) -> Frequent:
    """At most ``most`` keys, those that occur ``least`` times or more."""
    levels = table.groupBy(F.floor(F.log2("f") * 4).alias("level")).agg(F.count("*").alias("n"), F.min("f").alias("least")).orderBy(F.col("level").desc()).collect()
    least, room = 2**62, most
    for row in levels:
        room -= row["n"]
        if room < 0:
            break
        least = row["least"]
    rows = table.where(F.col("f") >= least).select("key", *columns).toArrow()
    keys = rows["key"].to_numpy().view(_U)
    order = np.argsort(keys)
    return Frequent(keys[order], tuple(rows[c].to_numpy()[order] for c in columns), least)


_PARTS = "id long, alike long, key long, n long, rows long, tokens long, known long, size long, base double, score double"


def _texts(sent_words, sent_events, counts: Counts):
    """Per text a row with the sums over its frequent words and events, and a row for each other one of it."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, events = sent_words.value.opened(), sent_events.value.opened()
        for rows in ragged.slices(batches):
            raw, offs = ragged.flat(rows.column("text"))
            n, sizes = rows.num_rows, np.diff(offs)
            buf = ragged.LOWER[raw]
            w = ragged.words(buf, offs)
            sums, others = [], []
            for table, keys, per_text in ((words, word_key(buf, w), np.diff(w.first)), (events, ragged.mix(grams(raw, offs)), sizes)):
                of = np.repeat(np.arange(n), per_text)
                at, hit = table.places(keys)
                sums += [np.bincount(of[hit], x[at[hit]], n) for x in table.values]
                rest = np.flatnonzero(~hit)
                _, first, often = np.unique(ragged.mix(keys[rest] ^ ragged.mix(of[rest].astype(_U))), return_index=True, return_counts=True)
                others.append((keys[rest[first]].view(np.int64), of[rest[first]], often))
            key, of, often = (np.concatenate(x) for x in zip(*others, strict=True))
            seen, base, lp = sums
            ids, alike = rows.column("id").to_numpy(), rows.column("alike").to_numpy()
            score = lp + sizes * math.log10(1 - counts.end) + math.log10(counts.end)
            own = [np.ones(n, np.int64), np.diff(w.first) + 1, seen.astype(np.int64) + int(counts.texts > 0), sizes, base + float(counts.base(np.array(counts.texts))), score]
            # a text's own row meets nothing; its key keeps such rows apart
            columns = [np.concatenate([ids, ids[of]]), np.concatenate([alike, alike[of]]), np.concatenate([alike, key]), np.concatenate([np.zeros(n, np.int64), often])]
            columns += [np.concatenate([x, np.zeros(len(of), x.dtype)]) for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in _PARTS.split(", ")])

    return score


def scored(docs: DataFrame, held_out, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte. ``held_out``
    is a condition on doc_id of the rows not to learn from."""
    spark, none = docs.sparkSession, -(2**63)
    send = spark.sparkContext.broadcast
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(none)).alias("id"), F.xxhash64("text").alias("alike"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    each = texts.select("text", "held_out")
    vocabulary = stored(each.mapInArrow(_words, "key long, c long, f long").groupBy("key").agg(F.sum("c").alias("c"), F.sum("f").alias("f")), "words")
    numbers = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    learn = texts.where("NOT held_out").agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    counts = Counts(*numbers, *learn)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    sent = each.mapInArrow(boxed(max(4 * tasks, size // BUCKET)), "bucket int, size long, blob binary")
    events_ = stored(dealt(sent, tasks).mapInArrow(joined, "size int, part binary"), "events")
    short = send(_short(events_))
    event_scores = stored(_scored_events(events_, short, fit(events_, short)), "event-scores")

    word_scores = vocabulary.select("key", "f", (F.col("c") > 0).cast("long").alias("seen"), F.log10((F.col("c") + 0.5) / F.lit(counts.all_tokens + 0.5 * (counts.types + (counts.texts > 0) + 1))).alias("one_base"))
    top_words = _frequent(word_scores, frequent, ["seen", "one_base"])
    top_events = _frequent(event_scores, frequent * EVENTS, ["lp"])
    parts = texts.select("id", "alike", "text").mapInArrow(_texts(send(top_words), send(top_events), counts), _PARTS)
    rare_words = word_scores.where(F.col("f") < top_words.least).select("key", "seen", "one_base", F.lit(0.0).alias("lp"))
    rare_events = event_scores.where(F.col("f") < top_events.least).select("key", F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("one_base"), "lp")
    rare = rare_words.union(rare_events).withColumnRenamed("key", "rare_key")
    both = parts.join(rare, (F.col("key") == F.col("rare_key")) & (F.col("rows") == 0), "left")
    plus = lambda x, y: F.sum(F.col(x) + F.coalesce(F.col("n") * F.col(y), F.lit(0))).alias(x)
    found = both.groupBy("id", "alike").agg(F.sum("rows").alias("rows"), F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), plus("known", "seen"), plus("base", "one_base"), plus("score", "lp"))
    # rows alike in id and text are summed together, and are as many as before
    out = found.withColumn("row", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    whole = lambda c: (F.col(c) / F.col("rows")).cast("long").alias
    return out.select(
        F.when(F.col("id") != none, F.col("id")).alias("doc_id"),
        whole("tokens")("n_tokens"),
        whole("known")("n_known"),
        F.lit(counts.all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
        F.when(F.col("size") > 0, -F.col("score") / F.col("size") / math.log10(2)).alias("bits_per_byte"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    found = scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), fold == HELD_OUT)
    return found.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
