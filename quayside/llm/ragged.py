"""Whole Arrow batches of texts as flat arrays: words, hashes of spans, sliding minima, gathered strings.

The functions here work on one slice of a batch at a time, so that memory follows the slice and not the partition.
A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of text that are worked on at a time, a little below a power of two as the tables of powers are rounded up.
SLICE = (1 << 20) - 64

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and ends."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = a.buffers()
    offs = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, offs - offs[0]


class Words(NamedTuple):
    """Where each word begins and ends in the bytes; ``first[i]`` is the first word of text i."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words(buf: np.ndarray, offs: np.ndarray, apart: np.ndarray = SPACE) -> Words:
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offs), np.int64))
    inside = ~apart[buf]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    begin = offs[:-1][offs[:-1] < len(buf)]
    opens[begin] = inside[begin]
    last = offs[1:] - 1
    closes[last] = inside[last]
    start = np.flatnonzero(opens)
    return Words(start, np.flatnonzero(closes) + 1, np.searchsorted(start, offs))


class Rolling:
    """64-bit hashes of any span of the bytes, or of 64-bit values: sums of a value times a power of an odd base, made independent of the place."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buf: np.ndarray, seed: int = 1):
        base = int(mix(np.array([seed * _ODD % 2**64], _U))[0]) | 5
        up, down = self._grown(base, len(buf) + 1)
        values = buf if buf.dtype == _U else (mix(np.arange(1, 257, dtype=_U) * _U(_ODD) + _U(seed)) | _U(1))[buf]
        self._down, self._sum = down, np.zeros(len(buf) + 1, _U)
        np.cumsum(values * up[: len(buf)], out=self._sum[1:])

    @classmethod
    def _grown(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        kept = cls._powers.get(base)
        if kept is None or len(kept[0]) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            steps = [np.full(size, r, _U) for r in (base, pow(base, -1, 2**64))]
            for s in steps:
                s[0] = 1
                np.cumprod(s, out=s)
            kept = cls._powers[base] = (steps[0], steps[1])
        return kept

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        plain = (self._sum[end] - self._sum[start]) * self._down[start]
        return mix(plain + (end - start).astype(_U) * _U(_ODD))

    def fixed(self, n: int) -> np.ndarray:
        """Of every span of n bytes."""
        if len(self._sum) <= n:
            return np.zeros(0, _U)
        return mix((self._sum[n:] - self._sum[:-n]) * self._down[: len(self._sum) - n])


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    got, size = values, 1
    while size * 2 <= width:
        got = np.minimum(got[:-size], got[size:])
        size *= 2
    rest = width - size
    return np.minimum(got[: len(got) - rest], got[rest:]) if rest else got


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def binary(buf: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary column over bytes that lie one after the other."""
    return pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))]).cast(pa.binary())


def distinct(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span the number of its content among the different ones, and a span of each content."""
    hashes = Rolling(buf).spans(start, end)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return number, first


def packed(arrays: list[np.ndarray]) -> bytes:
    """Several arrays as one compressed string."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return pa.compress(sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)


def unpacked(blob: bytes, size: int, kinds: list[type]) -> list[np.ndarray]:
    """The arrays of a compressed string that has ``size`` bytes when open."""
    raw = pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    starts = sizes.nbytes + offsets(sizes)
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(starts[:-1], starts[1:], kinds, strict=True)]
