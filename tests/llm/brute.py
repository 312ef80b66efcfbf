"""Plain forms of the operators for small tables."""

import binascii
import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import xxhash

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text):
    return [w for w in SPACES.split(text or "") if w]


def shingles(text, width):
    w = words_of(lower(text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def smallest(nodes, linked):
    """Component of each node by a predicate on pairs."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[:i]:
            if linked(a, b):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near_duplicates(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    found = smallest(sets, lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def vector_links(rows, cosine):
    def unit(v):
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        return [x / math.sqrt(sum(y * y for y in v)) for x in v] if ok else None

    kept = {i: (label, unit(v)) for i, v, label in rows}

    def linked(a, b):
        (la, x), (lb, y) = kept[a], kept[b]
        return la is not None and la == lb and x is not None and y is not None and len(x) == len(y) and sum(p * q for p, q in zip(x, y, strict=True)) >= cosine

    found = smallest(kept, linked)
    return {i: (sum(linked(i, j) for j in kept if j != i), found[i], found[i] == i) for i in kept}


def contamination(docs, items, window):
    def split(text):
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or "")) if w]

    windows = {}
    for i, text in items:
        w = split(text)
        if w and i is not None:
            for k in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for i, text in docs:
        w, hit, names = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    names |= found
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def base_scores(docs):
    held = {i: i is not None and binascii.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    split = [(i, words_of(lower(t or ""))) for i, t in docs]
    c, texts = Counter(), 0
    for i, w in split:
        if not held[i]:
            c.update(w)
            texts += 1
    n = sum(c.values()) + texts
    below = n + 0.5 * (len(c) + (texts > 0) + 1)
    log = lambda x: math.log10((x + 0.5) / below)
    return [(i, held[i], len(w) + 1, sum(c[x] > 0 for x in w) + (texts > 0), n, sum(log(c[x]) for x in w) + log(texts)) for i, w in split]


def token_rows(rows, encode, end_id=0):
    """start, n_tokens and crc32 of rows in order."""
    out, start = [], 0
    for i, text in rows:
        ids = [*encode(text or ""), end_id]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


def passages(rows, width):
    order = lambda i: 2**63 if i is None else i
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, 2**63), order(i))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = {j for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < order(i) for j in range(k, k + width)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def byte_strings(rows, width):
    """Rows with different ids, in any order."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            key = raw[k : k + width]
            if key in seen:
                gone[k : k + width] = b"\1" * width
            seen.add(key)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes):
    """Targets of sources by shares of 1, 2, 3, ... with the excess over three times a size shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        below = sum(weight[s] for s in names if s not in full)
        found = {s: 3.0 * sizes[s] if s in full else left * weight[s] / below for s in names}
        over = {s for s in names if s not in full and found[s] > 3 * sizes[s]}
        if not over:
            return found
        full |= over


def spark_hash(*values):
    """Unsigned; null leaves the hash as it is."""
    h = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v
            h = xxhash.xxh64(data, seed=h).intdigest()
    return h


def _long(x):
    return struct.pack("<q", x)


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def permuted(x, n, seed, rounds=24):
    """``seed`` is a signed long."""
    for i in range(rounds):
        turn = struct.pack("<i", i)
        other = (_signed(spark_hash(_long(seed), turn)) % n - x) % n
        if spark_hash(turn, _long(seed), _long(max(x, other))) & 1:
            x = other
    return x


def packed_mix(rows, block, shard_size, chunks):
    """shard, slot, source, block, n_words, text of every slot."""
    by_key, source_of = {}, {}
    for i, t, s in rows:
        key = "" if s is None else "=" + s
        source_of[key] = s
        alike = _signed(spark_hash(t))
        chunk = _signed(spark_hash(None if i is None else _long(i), _long(alike))) % chunks
        by_key.setdefault(key, []).append((chunk, i is not None, i or 0, alike, words_of(t)))
    stream = {k: [w for d in sorted(v, key=lambda d: d[:4]) for w in d[4]] for k, v in by_key.items()}
    want = targets({source_of[k]: len(v) for k, v in stream.items()})
    draws, blocks = {}, {k: -(-len(v) // block) for k, v in stream.items()}
    for k, v in stream.items():
        if v:
            draws[k] = min(math.floor(want[source_of[k]] * blocks[k] / len(v) + 0.5), 3 * blocks[k])
    shards = -(-sum(draws.values()) // shard_size)
    counts = {}
    for k, n in draws.items():
        for d in range(n):
            at = _signed(spark_hash(k, _long(d))) % shards
            counts.setdefault(at, {}).setdefault(k, 0)
            counts[at][k] += 1
    out, done = [], dict.fromkeys(draws, 0)
    for shard in sorted(counts):
        total, place = sum(counts[shard].values()), 0
        for k in sorted(counts[shard]):
            for _ in range(counts[shard][k]):
                lap, turn = divmod(done[k], blocks[k])
                b = permuted(turn, blocks[k], _signed(spark_hash(k, _long(lap))))
                text = stream[k][b * block : (b + 1) * block]
                out.append((shard, permuted(place, total, _signed(spark_hash(_long(shard)))), source_of[k], b, len(text), " ".join(text)))
                done[k] += 1
                place += 1
    return out
