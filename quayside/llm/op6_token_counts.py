"""Token counts: byte-pair merges of many pieces of text at once, on ragged numpy arrays.

A sentence-piece file of the byte-pair kind merges, again and again, the two neighbours whose joined text has the best
rank, the leftmost of equals. Here the different pieces of a slice of texts are held as one array of symbols; each round
finds every piece's best pair and joins all its places that do not overlap, for all pieces at the same time, until no
pair of any piece is known. If joining a pair makes one of a better rank than the joined, only the leftmost place counts
in that round, so the order of merges stays the library's. Pieces that are not done after ``ROUNDS`` rounds (long runs
without spaces) go on by rank: their symbols are linked arrays, the places of a rank wait in a bucket, and all places of
the lowest rank are joined at a time, so that a round touches those places only and not all that is left. Then the symbols
left are counted; a character without a symbol of its own counts as its bytes.

No token of the file has its space mark after another character, so a text is cut before each run of spaces (the space
mark in a text is a space for the file, too), and a piece
that was seen before in the worker is not merged again. The file adds one space before a text that is not empty. What
the file does to characters (none here) is asked of the library once; a file that changes them, or whose tokens cross
those cuts, is refused.

Defined results: a null or empty text has no bytes and no tokens. Rows that repeat a document are counted each. Long texts
are one slice each, with or without spaces. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ragged

LIMIT = 4096
#: Distinct pieces kept in a Python worker; beyond that it begins anew.
KEPT = 1_000_000
MARK = "▁"
#: Rounds over all that is left, before what is not done yet goes on by rank.
ROUNDS = 24

_loaded: dict[str, Merges] = {}
_NONE = np.iinfo(np.int64).max


class Merges:
    """Ranks of the pairs of symbols. A symbol is a token's number, or an unknown character's code point after them."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "a   b\tcﬁ ÅÅ "
        if sp.Normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("a file that changes characters is not supported")
        kinds = [(sp.id_to_piece(i), i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(MARK in p.lstrip(MARK) for p, _ in kinds):
            raise ValueError("a token crosses the cut before a space")
        score = {p: sp.get_score(i) for p, i in kinds}
        order = sorted({-s for s in score.values()})
        rank_of = {s: r for r, s in enumerate(order)}
        # symbols: the file's tokens, then characters that are only part of them
        self.number = {p: i for i, (p, _) in enumerate(kinds)}
        chars = sorted({c for p in score for c in p} - self.number.keys())
        self.known = len(kinds)
        self.number |= {c: self.known + i for i, c in enumerate(chars)}
        self.base = len(self.number)
        found = {}
        for p in score:
            for cut in range(1, len(p)):
                a, b = self.number.get(p[:cut]), self.number.get(p[cut:])
                if a is not None and b is not None:
                    found[a * self.base + b] = (rank_of[-score[p]], self.number[p])
        self.pairs = np.array(sorted(found), np.int64)
        self.rank = np.array([found[int(k)][0] for k in self.pairs], np.int64)
        self.joined = np.array([found[int(k)][1] for k in self.pairs], np.int64)
        self.chars = np.full(0x110000, -1, np.int64)
        for c, i in self.number.items():
            if len(c) == 1:
                self.chars[ord(c)] = i
        self.counts: dict[bytes, int] = {}

    @classmethod
    def of(cls, path: str) -> Merges:
        """One in each Python worker."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and what it becomes."""
        known = (left < self.base) & (right < self.base)
        key = np.where(known, left * self.base + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.joined[at], -1)

    def merged(self, symbols: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of n pieces; ``of`` is each symbol's piece, ascending."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(ROUNDS):
            if len(symbols) < 2:
                break
            rank, become = self._ranks(symbols[:-1], symbols[1:])
            rank[of[:-1] != of[1:]] = _NONE
            best = np.full(n, _NONE)
            np.minimum.at(best, of[:-1], rank)
            at_best = best[of]
            live = at_best < _NONE
            if not live.all():  # finished pieces go
                out.append((symbols[~live], of[~live]))
                symbols, of, at_best = symbols[live], of[live], at_best[live]
                stay = live[:-1] & live[1:]
                rank, become = rank[stay], become[stay]
                if len(symbols) < 2:
                    break
                # neighbours of different pieces that now stand side by side
                if len(rank) != len(symbols) - 1:
                    rank, become = self._ranks(symbols[:-1], symbols[1:])
                    rank[of[:-1] != of[1:]] = _NONE
            place = np.flatnonzero(rank == at_best[:-1])
            # in a chain of places that overlap, every second one
            chain = np.ones(len(place), bool)
            chain[1:] = np.diff(place) > 1
            start = np.flatnonzero(chain)
            nth = np.arange(len(place)) - np.repeat(start, np.diff(np.append(start, len(place))))
            place = place[nth % 2 == 0]
            symbols, of = self._joined(symbols, of, place, become, at_best)
        out.append(self._by_rank(symbols, of))
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])

    def _joined(self, symbols: np.ndarray, of: np.ndarray, place: np.ndarray, become: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = symbols.copy()
        new[place] = become[place]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        got, got_of = new[keep], of[keep]
        fresh = np.zeros(len(symbols), bool)
        fresh[place] = True
        fresh = fresh[keep]
        beside = fresh[:-1] | fresh[1:]
        rank, _ = self._ranks(got[:-1], got[1:])
        early = got_of[:-1][beside & (got_of[:-1] == got_of[1:]) & (rank < best[keep][:-1])]
        # the same for a symbol that is joined itself only after this place
        close = place[:-1][(place[1:] == place[:-1] + 2) & (of[place[1:]] == of[place[:-1]])]
        rank, _ = self._ranks(become[close], symbols[close + 2])
        early = np.concatenate([early, of[close[rank < best[close]]]])
        if not len(early):
            return got, got_of
        # those pieces join their leftmost place only
        careful = np.unique(early)
        first = np.ones(len(place), bool)
        first[1:] = of[place[1:]] != of[place[:-1]]
        place = place[first | ~np.isin(of[place], careful)]
        new = symbols.copy()
        new[place] = become[place]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        return new[keep], of[keep]

    def _by_rank(self, symbols: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of pieces that may be long. Symbol ``n`` stands for no symbol; it has no rank with any other."""
        n = len(symbols)
        if n < 2:
            return symbols, of
        none = self.base + len(self.chars)  # beyond every character
        sym = np.append(symbols, none)
        last = np.append(of[:-1] != of[1:], True)
        after = np.append(np.where(last, n, np.arange(1, n + 1)), n)
        before = np.append(np.where(np.append(True, last[:-1]), n, np.arange(-1, n - 1)), n)
        rank, become = self._ranks(sym, sym[after])
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < _NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            of_place = rank[places]
            begins = np.flatnonzero(np.append(True, of_place[1:] != of_place[:-1])) if len(places) else of_place
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(places)], strict=False):
                r = int(of_place[a])
                if r not in waiting:
                    heapq.heappush(ranks, r)
                waiting.setdefault(r, []).append(places[a:b])

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            groups = waiting.pop(r)
            places = np.unique(np.concatenate(groups)) if len(groups) > 1 else groups[0]
            places = places[rank[places] == r]
            if not len(places):
                continue
            if len(places) > 1:
                places = self._in_order(places, sym, before, after, become, of, r, wait)
            gone = after[places]
            behind = after[gone]
            sym[places] = become[places]
            after[places] = behind
            before[behind] = places
            sym[gone], rank[gone] = none, _NONE
            left = before[places]
            touched = np.unique(np.concatenate([places, left[left < n]]))
            rank[touched], become[touched] = self._ranks(sym[touched], sym[after[touched]])
            wait(touched)
        live = sym[:n] != none
        return sym[:n][live], of[live]

    def _in_order(self, places: np.ndarray, sym: np.ndarray, before: np.ndarray, after: np.ndarray, become: np.ndarray, of: np.ndarray, r: int, wait: Callable[[np.ndarray], None]) -> np.ndarray:
        """Of the places of a rank those that the library would join before any of a better rank comes up; the others wait."""
        chain = np.append(True, after[places[:-1]] != places[1:])
        start = np.flatnonzero(chain)
        nth = np.arange(len(places)) - np.repeat(start, np.diff(np.append(start, len(places))))
        taken = places[nth % 2 == 0]
        # what stands beside a place when it is joined: to the left what earlier places made, to the right what is there now
        left = sym[before[taken]]
        made = np.append(False, after[taken[:-1]] == before[taken[1:]])
        left[made] = become[taken[:-1]][made[1:]]
        right = sym[after[after[taken]]]
        new = become[taken]
        early = np.flatnonzero((self._ranks(left, new)[0] < r) | (self._ranks(new, right)[0] < r))
        if not len(early):
            return taken
        piece, at = np.unique(of[taken[early]], return_index=True)
        until = np.full(int(of[places[-1]]) + 1, len(sym))
        until[piece] = taken[early[at]]
        wait(places[places > until[of[places]]])
        return taken[taken <= until[of[taken]]]

    def count_new(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece, a text in which a space is the space mark."""
        points = np.frombuffer("".join(texts := [p.decode("utf-8", "replace") for p in pieces]).replace(" ", MARK).encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        symbols = self.chars[points]
        symbols = np.where(symbols < 0, self.base + points, symbols)
        left, of = self.merged(symbols, of, len(texts))
        code = left - self.base
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        if self.base > self.known:  # characters that occur in tokens only, and have none of their own
            names = {i: len(c.encode()) for c, i in self.number.items() if i >= self.known}
            part = (left >= self.known) & (left < self.base)
            size[part] = [names[int(i)] for i in left[part]]
        return np.bincount(of, np.where(left < self.known, 1, size), len(texts)).astype(np.int64)

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        if len(self.counts) > KEPT:
            self.counts.clear()
        buf, offs = ragged.flat(texts)
        sizes = written = np.diff(offs)
        # the space mark itself in a text is a space for the file
        marks = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) if len(buf) > 2 else np.zeros(0, np.int64)
        if len(marks):
            shorter = np.ones(len(buf), bool)
            shorter[marks + 1] = shorter[marks + 2] = False
            buf = buf.copy()
            buf[marks] = 0x20
            buf, offs = buf[shorter], ragged.offsets(shorter)[offs]
            sizes = np.diff(offs)
        # one space before each text that is not empty
        full = np.flatnonzero(sizes)
        buf, offs = np.insert(buf, offs[full], 0x20), offs + np.concatenate([[0], np.cumsum(sizes > 0)])
        raw = buf.tobytes()
        blank = buf == 0x20
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[offs[:-1][np.diff(offs) > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(buf))
        number, first = ragged.distinct(buf, start, end)
        pieces = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        found = np.fromiter(map(self.counts.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [pieces[i] for i in missing]
            found[missing] = self.count_new(new)
            self.counts.update(zip(new, found[missing].tolist(), strict=True))
        total = np.concatenate([[0], np.cumsum(found[number])])
        return written, np.diff(total[np.searchsorted(start, offs)])


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    import public_tokenizers

    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges.of(path)
        for rows in ragged.slices(batches):
            sizes, counts = merges.count(rows.column("text"))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sizes), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
