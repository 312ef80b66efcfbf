"""Encoding whole texts with a public tokenizers file, each distinct piece of text once in a worker.

The byte-level file splits a text into runs of letters, of digits, of other characters, each with one space before it, and
white space; no token goes over such a border. Pieces here end only at those borders: a word with one space before it,
its last punctuation mark, white space. The library itself splits and encodes each piece.

Texts for which that is not certain go to the library as they are: with white space other than ASCII's, control
characters, a special token's text, or a very long piece.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa

from quayside.llm import ragged

#: Distinct pieces kept in a Python worker; beyond that it keeps those met again since, or begins anew where these are most.
KEPT = 400_000
#: New words that are encoded as one text.
TOGETHER = 1 << 12
#: A text with a longer word goes to the library as it is.
LONGEST = 256

#: White space of Unicode, format and control characters.
UNSURE = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
#: The first bytes of those characters.
_ODD = np.array([(b < 0x20 and not ragged.SPACE[b]) or b in (0x7F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF) for b in range(256)])
_MARK = np.array([b < 0x80 and chr(b).isprintable() and not chr(b).isalnum() and b != 0x20 for b in range(256)])
_PLAIN = np.array([b < 0x80 and chr(b).isalnum() for b in range(256)])

_loaded: dict[str, BytePieces] = {}


class BytePieces:
    """Token ids of texts by a tokenizers file, without begin and end; special tokens inside texts as the library's default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        # the bytes of each token: a character for each, as the byte-level files write them
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        self.sizes[list(vocab.values())] = [len(added[i].content.encode()) if i in added else len(t) for t, i in vocab.items()]
        self._clear()

    @classmethod
    def of(cls, path: str) -> BytePieces:
        """One in each Python worker."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # of each piece in ids
        self.again = np.zeros(1 << 14, bool)  # met after it was learned

    def _trim(self) -> None:
        """Keeps the pieces met again, as texts repeat their frequent ones and meet most others once."""
        n = len(self.place)
        again = self.again[:n]
        if 2 * np.count_nonzero(again) > n:
            return self._clear()
        starts = np.concatenate([[0], self.ends[: n - 1]])
        kept = np.flatnonzero(again)
        lengths = self.ends[kept] - starts[kept]
        self.ids = self.ids[ragged.ranges(starts[kept], lengths)]
        # numbers were given in the order of the dictionary
        self.place = dict(zip(itertools.compress(self.place, again.tolist()), range(len(kept)), strict=True))
        self.ends, self.again = np.cumsum(lengths), np.zeros(len(kept), bool)

    def _learn(self, pieces: list[bytes], words: int) -> None:
        """``words``: how many of the pieces, the last ones, are a word with one space before it."""
        n = len(self.place)
        cut = len(pieces) - words
        (got, lengths), (more, sizes) = self._each(pieces[:cut]), self._together(pieces[cut:])
        got, lengths = np.concatenate([got, more]), np.concatenate([lengths, sizes])
        at, total = int(self.ends[n - 1]) if n else 0, len(got)
        self.ids, self.ends, self.again = _room(self.ids, at + total), _room(self.ends, n + len(pieces)), _room(self.again, n + len(pieces))
        self.ids[at : at + total] = got
        self.ends[n : n + len(pieces)] = at + np.cumsum(lengths)
        self.place.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and how many each has."""
        got = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(lengths.sum())), lengths

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words with one space before them. As no token goes over a border before such a space, a text made of
        them has the ids of each, and is cut by the bytes of its tokens. Should a word not end with a token, each is encoded alone."""
        texts = [b"".join(words[at : at + TOGETHER]).decode() for at in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False))])
        ends, want = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.searchsorted(ends, want)
        if len(words) and (not len(ends) or ends[-1] != want[-1] or (ends[at] != want).any()):
            return self._each(words)
        return ids, np.diff(at, prepend=-1)

    def _odd(self, raw: bytes, buf: np.ndarray, offs: np.ndarray) -> list[int]:
        """Texts that the library must see whole."""
        odd = set((np.searchsorted(offs, np.flatnonzero(_ODD[buf]), "right") - 1).tolist())
        odd = {i for i in odd if UNSURE.search(raw[offs[i] : offs[i + 1]].decode())}
        for content in self.added:
            at = raw.find(key := content.encode())
            while at >= 0:
                odd.add(int(np.searchsorted(offs, at, "right") - 1))
                at = raw.find(key, at + 1)
        w = ragged.words(buf, offs)
        long = w.start[w.end - w.start > LONGEST]
        return sorted(odd | set((np.searchsorted(offs, long, "right") - 1).tolist()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids begin and end. A null text has none."""
        if len(self.place) > KEPT:
            self._trim()
        buf, offs = ragged.flat(texts)
        raw = buf.tobytes()
        apart = {i: self.library.encode(raw[offs[i] : offs[i + 1]].decode(), add_special_tokens=False).ids for i in self._odd(raw, buf, offs)}
        start, end = pieces(buf, offs)
        number, first = ragged.distinct(buf, start, end)
        different = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        places = np.fromiter(map(self.place.get, different, itertools.repeat(-1)), np.int64, len(different))
        self.again[places[places >= 0]] = True
        missing = np.flatnonzero(places < 0)
        if len(missing):
            one = first[missing]
            word = (buf[start[one]] == 0x20) & (end[one] - start[one] > 1)
            missing = np.concatenate([missing[~word], missing[word]])
            places[missing] = len(self.place) + np.arange(len(missing))
            self._learn([different[i] for i in missing.tolist()], np.count_nonzero(word))
        places = places[number]
        ends = self.ends[places]
        starts = np.where(places > 0, self.ends[places - 1], 0)
        lengths = ends - starts
        ids = self.ids[ragged.ranges(starts, lengths)]
        of_text = ragged.offsets(lengths)[np.searchsorted(start, offs)]
        if apart:
            parts = [np.array(apart[i], np.uint32) if i in apart else ids[of_text[i] : of_text[i + 1]] for i in range(len(texts))]
            return np.concatenate(parts), ragged.offsets(np.array([len(x) for x in parts]))
        return ids, of_text


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, with zeros after it where it has fewer than n places."""
    return array if len(array) >= n else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])


def pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end; together they are the whole texts."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = ragged.words(buf, offs)
    of_text, of_word, begins = (np.zeros(len(buf) + 1, bool) for _ in range(3))
    of_text[offs] = of_word[w.start] = True
    begins[offs] = begins[w.start] = begins[w.end] = True
    # white space before a word: its last space belongs to the word, another last character stands alone
    last = np.flatnonzero(of_word[1:] & ~of_text[1:] & ragged.SPACE[buf])
    begins[last] = True
    begins[last[buf[last] == 0x20] + 1] = False
    marks = w.end - 1
    marks = marks[(marks > w.start) & _MARK[buf[marks]]]
    begins[marks[_PLAIN[buf[marks - 1]]]] = True
    begins[-1] = True
    found = np.flatnonzero(begins)
    return found[:-1], found[1:]
