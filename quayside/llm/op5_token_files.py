"""Token-ID output: ids of all documents one after the other in Parquet segments, with Elias-Fano encoded boundaries.

Documents are dealt by ranges of doc_id and sorted; each task encodes its texts and cuts them, between documents, into
segments of about ``SEGMENT_IDS`` ids. A segment is one row of the written table:

    part, piece      its place in the order of all segments
    n_ids, ids       the ids, little-endian, ``id_bytes`` wide (2 where the vocabulary allows, else 4)
    n_docs, doc_ids  the documents, in order
    low, high, picks Elias-Fano code of where each document ends in ``ids``, and its select samples

A boundary's lowest ``low_bits`` bits lie packed in ``low``; the rest is written in ``high`` as gaps in unary, n + u / 2^l
bits for n boundaries below u. ``picks`` holds the place of every 256th one in ``high``, so one boundary is found from
a sample and the few words after it, without a table of 64-bit offsets.

Parquet commits a write as a whole, and a lost executor's segments are written anew. Defined results: a null or empty
text has only the end id. Documents without an id come last; rows that repeat an id are ordered by text and kept all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm import ragged
from quayside.llm.tokens import BytePieces
from quayside.session import scratch_path

SEGMENT_IDS = 1 << 20
END_ID = 0
SAMPLE = 256


class Boundaries:
    """An ascending sequence of numbers as Elias-Fano code."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, picks: bytes):
        self.n, self.low_bits, self.low, self.high, self.picks = n, low_bits, low, high, picks

    @classmethod
    def encoded(cls, values: np.ndarray) -> Boundaries:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        pack = lambda x: np.packbits(x.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, pack(bits), pack(high), ones[::SAMPLE].astype("<u4").tobytes())

    def _lows(self, first: int, n: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(n, np.int64)
        at = first * self.low_bits
        part = np.frombuffer(self.low, np.uint8)[at // 8 : (at + n * self.low_bits + 7) // 8]
        bits = np.unpackbits(part, bitorder="little")[at % 8 : at % 8 + n * self.low_bits].reshape(n, self.low_bits)
        return bits @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        return ((ones - np.arange(len(ones))) << self.low_bits) | self._lows(0, self.n)

    def select(self, i: int) -> int:
        """The i-th number, from the sample before it and the bytes that follow."""
        at = int(np.frombuffer(self.picks, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        word = self.high[byte] >> (at % 8) << (at % 8)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | int(self._lows(i, 1)[0])


_SEGMENT = pa.schema(
    [("part", pa.int32()), ("piece", pa.int32()), ("n_ids", pa.int64()), ("id_bytes", pa.int32()), ("ids", pa.binary()), ("n_docs", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("picks", pa.binary())]
)
_SEGMENT_SQL = "part int, piece int, n_ids long, id_bytes int, ids binary, n_docs long, doc_ids array<long>, low_bits int, low binary, high binary, picks binary"


def write_segments(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes ``docs`` (doc_id, text) as segments below ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        library = BytePieces.of(tokenizer)
        width = 2 if library.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        part, piece, held, names, ends, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def segment() -> pa.RecordBatch:
            b = Boundaries.encoded(np.concatenate(ends))
            row = [part, piece, size, width, b"".join(held), b.n, [x for n in names for x in n], b.low_bits, b.low, b.high, b.picks]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT, strict=True)], schema=_SEGMENT)

        for rows in ragged.slices(batches):
            ids, offs = library.encode(rows.column("text"))
            # the end id after each document
            ids, offs = np.insert(ids, offs[1:], end_id), offs + np.arange(len(offs))
            held.append(ids.astype(f"<u{width}").tobytes())
            names.append(rows.column("doc_id").to_pylist())
            ends.append(size + offs[1:])
            size += len(ids)
            if size >= segment_ids:
                yield segment()
                piece, held, names, ends, size = piece + 1, [], [], [], 0
        if ends:
            yield segment()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, order[0]).sortWithinPartitions(*order)
    rows.mapInArrow(encode, _SEGMENT_SQL).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in batch.to_pylist():
            ids = np.frombuffer(s["ids"], f"<u{s['id_bytes']}").astype("<u4")
            ends = Boundaries(s["n_docs"], s["low_bits"], s["low"], s["high"], s["picks"]).all()
            starts = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            place = [pa.array([s[c]] * s["n_docs"], pa.int32()) for c in ("part", "piece")]
            columns = [*place, pa.array(s["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "piece", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the written segments, per document: doc_id, start (ids before it), n_tokens, ids_crc32.

    What lies before a segment is summed in two steps, over the parts and within a part, so no task gets all segments.
    The ids are read where they lie; only the digests are joined with that.
    """
    segments = spark.read.schema(_SEGMENT_SQL).parquet(path)
    sizes = segments.select("part", "piece", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    inner = sizes.select("part", "piece", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("piece")) - F.col("n_ids")).alias("within"))
    place = inner.join(before_part, "part").select("part", "piece", (F.col("earlier") + F.col("within")).alias("before"))
    found = segments.mapInArrow(_digests, "part int, piece int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(place, ["part", "piece"]).select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the files (to a fresh shared folder unless ``path`` is given) and reads their digests back."""
    import public_tokenizers

    path = path or scratch_path(spark, "token-files")
    write_segments(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_digests(spark, path)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
