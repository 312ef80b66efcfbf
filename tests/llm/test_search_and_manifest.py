"""Ranked search, nearest neighbours and the manifest against plain forms, on small tables with nulls, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import words
from pyspark.sql import functions as F

from quayside.llm import op11_treap as op11
from quayside.llm import op12_forest as op12
from quayside.llm import op13_manifest as op13
from quayside.session import scratch_path


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def plain_sort(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def clashing():
    """Adds columns that the operators use as names of their own."""

    def add(frame):
        names = "term tf row block batch rank score key pos n digest changed leaf root lang_key vec query_id unit cells nth part".split()
        return frame.withColumns({x: F.lit(f"own {x}") for x in names})

    return add


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=10):
    terms = [(i, Counter(TERM.findall(brute.lower(t or "")))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n, every = len(terms), sum(c.total() for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(TERM.findall(brute.lower(t or "")))
    found = []
    for item, some in asked.items():
        scores = []
        for doc, c in terms:
            m = 100 - 90 + (90 * c.total() * n) // every
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in some if c[w])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return found


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(11)
    docs = [(7 * i % 301, words(rng, rng.randrange(1, 60), 120)) for i in range(300)]
    docs += [(400 + i, "same words w1 w2 here") for i in range(40)] + [(400, "same words w1 w2 here"), (None, "same words w1")]
    docs += [(500, None), (501, ""), (502, " .,- \n"), (503, "Ärger ÄRGER straße 日本語 w1é"), (504, words(rng, 30_000, 500)), (505, "w1 W1 w1,w1"), (506, "a\x00b c")]
    items = [(i, words(rng, rng.randrange(1, 12), 120)) for i in range(30)]
    items += [(90, "same words here"), (91, None), (92, ""), (93, "not-there-at-all zz"), (94, "ÄRGER 日本語"), (95, "w1 w1 W1"), (None, "w1"), (96, "w3"), (96, "w4 w5")]
    return docs, items


@pytest.mark.parametrize("postings", [1, 40, 1 << 19])
def test_search_equals_brute_force(spark, docs_of, clashing, searched, postings):
    docs, items = searched
    path = scratch_path(spark, "test-treap")
    documents = op11.write_index(clashing(docs_of(docs)).repartition(3), path, postings)
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"))
    assert plain_sort(rows_of(op11.search(spark, path, documents, asked))) == plain_sort(plain_search(docs, items))


def test_search_deals_many_items_and_takes_text_ids(spark, docs_of, searched, monkeypatch):
    monkeypatch.setattr(op11, "ITEMS", 5)
    docs, items = searched
    items = [(None if i is None else f"q{i}", t) for i, t in items]
    found = op11.ranked(docs_of(docs), spark.createDataFrame(items, "item_id string, text string"), k=3)
    assert plain_sort(rows_of(found)) == plain_sort(plain_search(docs, items, 3))


def test_search_of_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows_of(op11.ranked(docs_of([]), one)) == []
    assert rows_of(op11.ranked(docs_of([(1, "a b"), (2, "c")]), none)) == []
    assert rows_of(op11.ranked(docs_of([(1, None)]), one)) == []
    assert plain_sort(rows_of(op11.ranked(docs_of([(1, "a")]), one))) == plain_sort(plain_search([(1, "a")], [(1, "a")]))


def test_index_rows_are_some_bytes_a_posting(spark, docs_of):
    """Spark holds a block's row several times over: terms and grid are compressed in it. Its terms come out in several batches."""
    rng = random.Random(6)
    docs = [(i, words(rng, 120, 30_000)) for i in range(400)]
    postings, kinds = sum(len({*t.split()}) for _, t in docs), len({w for _, t in docs for w in t.split()})
    path = scratch_path(spark, "test-treap")
    documents = op11.write_index(docs_of(docs).coalesce(1), path)
    rows = spark.read.parquet(path).toArrow()
    assert rows.num_rows == 1 and kinds > op11._UNFOLDED
    assert rows.nbytes < 8 * postings
    items = [(i, words(rng, 8, 30_000)) for i in range(20)]
    found = op11.search(spark, path, documents, spark.createDataFrame(items, "item_id long, text string"))
    assert plain_sort(rows_of(found)) == plain_sort(plain_search(docs, items))


def test_grid_visits_part_of_the_columns():
    """The queue drops ranges that can't reach the best: few of many columns are looked at."""
    rng = np.random.default_rng(5)
    column = np.arange(4096)
    value = rng.integers(1, 1000, 4096)
    value[1234] = 5000
    grid = op11.Grid.built(np.zeros(4096, np.int64), column, value, 1, 4096)
    looked = 0
    quarters = grid._quarters

    def counted(cells, *rest):
        nonlocal looked
        looked += len(cells)
        return quarters(cells, *rest)

    grid._quarters = counted
    assert grid.best(np.array([0]), np.array([2]), 1) == [(1234, 10_000)]
    assert looked < 2000


# --- nearest neighbours


def plain_neighbours(rows, every, k):
    valid = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    found = {}
    for q, a in valid:
        if q % every == 0:
            best = found.setdefault(q, {})
            for i, b in valid:
                if i != q:
                    s = float(sum(np.float64(x) * y for x, y in zip(a, b, strict=False)))
                    best[i] = max(best.get(i, -math.inf), s)
    return {(q, r, i): s for q, best in found.items() for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k], 1) for s in [-s]}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def test_neighbours_of_all_cells_are_exact(spark, clashing):
    """With a target of all neighbours the queue runs to where the probes, here all queries, met theirs."""
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(6)]) for i in range(400)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0]) for i in range(400, 470)] + [(20, rows[20][1]), (21, [9.0] * 6), (None, [9.0] * 6)]
    rows += [(480, None), (481, []), (482, [0.0] * 6), (483, [nan] * 6), (500, [inf] + [1.0] * 5), (485, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (486, [3.0, 1.0]), (520, [0.5])]
    frame = clashing(vectors(spark, rows))
    found = rows_of(op12.neighbours(frame, F.col("vec_id") % 20 == 0, k=5, target=1.0, cell=8, unit=64, group=16, sample=200, sparse=2))
    plain = plain_neighbours(rows, 20, 5)
    got = {(q, r, i): s for q, r, i, s in found}
    assert len(got) == len(found)
    assert got.keys() == plain.keys()
    assert all(abs(s - plain[key]) < 1e-12 for key, s in got.items())


def test_neighbours_recall_on_rows_without_structure(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x *= rng.uniform(0.5, 2, size=(3000, 1)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    found = rows_of(op12.neighbours(vectors(spark, rows), F.col("vec_id") % 20 == 0, cell=16, unit=512))
    wide = x.astype(np.float64)
    true = 0
    by_query = {}
    for q, r, i, s in found:
        by_query.setdefault(q, []).append((r, i))
        assert abs(s - float(wide[q] @ wide[i])) < 1e-9
    for q in range(0, 3000, 20):
        scores = wide @ wide[q]
        scores[q] = -np.inf
        best = set(np.argsort(-scores)[:20].tolist())
        ranks = sorted(by_query[q])
        assert [r for r, _ in ranks] == list(range(1, 21))
        true += len(best & {i for _, i in ranks})
    assert true / (150 * 20) >= 0.9


def test_clustered_rows_need_few_cells(spark):
    """The budget follows the data: with tight groups the queue ends early."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = (centres[:, None] + 0.01 * rng.normal(size=(40, 50, 16))).reshape(-1, 16)
    x /= np.linalg.norm(x, axis=1, keepdims=True)  # a query lies where the same row does
    forest = op12.Forest(x, float(np.linalg.norm(x, axis=1).max()), len(x), cell=32, unit=512)
    cells = forest.cells(x)
    for t in range(cells.shape[1]):
        forest.sizes[t] = np.bincount(cells[:, t], minlength=1 << forest.levels)
    assert all(s.sum() == len(x) for s in forest.sizes)
    order, held = forest.queue(x[:1])
    first = {int(c) >> forest.levels: int(c) & ((1 << forest.levels) - 1) for c in order[0, :4]}
    assert all(cells[0, t] == c for t, c in first.items())
    assert held[0, 3] < len(x)


def test_neighbours_of_an_empty_table(spark):
    assert rows_of(op12.neighbours(vectors(spark, []), F.col("vec_id") % 20 == 0)) == []
    assert rows_of(op12.neighbours(vectors(spark, [(20, [1.0, 0.0])]), F.col("vec_id") % 20 == 0)) == []
    assert rows_of(op12.neighbours(vectors(spark, [(20, [1.0, 0.0]), (1, [2.0, 0.0])]), F.col("vec_id") % 20 == 0)) == [(20, 1, 1, 2.0)]


# --- manifest


def sha(b):
    return hashlib.sha256(b).hexdigest()


def plain_leaf(row, text):
    """``row`` has doc_id, source, lang, n_chars."""
    parts = [None if v is None else str(v).encode() for v in (*row[:4], text)]
    return sha(b"".join(b"-" if p is None else str(len(p)).encode() + b":" + p for p in parts))


def plain_tree(level):
    """The root, and of each leaf what stands left and right of it, level by level."""
    paths, below = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [range(j, min(j + 8, len(level))) for j in range(0, len(level), 8)]
        for run in runs:
            for at in run:
                for i in below[at]:
                    paths[i].append(("".join(level[x] for x in run if x < at), "".join(level[x] for x in run if x > at)))
        level, below = [sha("".join(level[x] for x in run).encode()) for run in runs], [[i for x in run for i in below[x]] for run in runs]
    return level[0], paths


def plain_manifest(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        ordered = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[4])))
        trees.append((ordered, *plain_tree([plain_leaf(r, r[4]) for r in ordered])))
    root, above = plain_tree([t[1] for t in trees]) if trees else (None, [])
    found = []
    for (ordered, subroot, paths), beyond in zip(trees, above, strict=True):
        for r, path in zip(ordered, paths, strict=True):
            whole, text = path + beyond, r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = brute.lower(text)
            at = plain_leaf(r, text)
            for a, b in whole:
                at = sha((a + at + b).encode())
            found.append((r[0], plain_leaf(r, r[4]), subroot, root, sha("".join(a + b for a, b in whole).encode()), at, at == root))
    return found


DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_brute_force(spark, clashing, monkeypatch, levels):
    """Blocks of 8 and 64 leaves make several steps of trees; the third form has all in one block."""
    monkeypatch.setattr(op13, "LEVELS", levels)
    monkeypatch.setattr(op13, "BLOCK", 8**levels)
    rng = random.Random(13)
    rows = [(i, f"s{i % 3}", "en", i, f"Text {words(rng, 5)}") for i in rng.sample(range(5000), 600)]
    rows += [(i, None, lang, None, t) for i, (lang, t) in enumerate([("de", "Straße"), (None, "A"), (None, None), ("", "x"), ("é", "y"), ("日", "")] * 11)]
    rows += [(3, "s", "fr", 1, "A B"), (3, "s", "fr", 1, "A B"), (3, "s", "fr", 1, "a b"), (None, "s", "fr", 1, "Z"), (None, None, "fr", None, None), (9, "s", "lone", 1, "One"), (10, "s", "long", 1, "Aé" * 200_000)]
    rows += [(i, "s", f"l{i}", 1, "T") for i in range(70)]
    frame = clashing(spark.createDataFrame(rows, DOCUMENTS)).repartition(5)
    found = rows_of(op13.manifest(frame).drop("lang"))
    assert plain_sort(found) == plain_sort(plain_manifest(rows))
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    assert rows_of(op13.manifest(spark.createDataFrame([], DOCUMENTS))) == []
    rows = [(1, None, None, None, None)]
    found = rows_of(op13.manifest(spark.createDataFrame(rows, DOCUMENTS)).drop("lang"))
    assert found == plain_manifest(rows)
    assert found[0][4] == sha(b"")


def test_aligned_append_extends_witnesses():
    whole, parts = op13.Witnesses(), op13.Witnesses()
    leaves = [sha(str(i).encode()).encode() for i in range(200)]
    nodes = [whole.append(x) for x in leaves]
    for at in range(0, 200, 64):  # subtrees of height 2, each worked out by itself
        part = op13.Witnesses()
        for x in leaves[at : at + 64]:
            part.append(x)
        parts.append(part.finish(2).digest, 2)
    root = whole.finish().digest
    assert parts.finish().digest == root
    for leaf, node in zip(leaves, nodes, strict=True):
        at = leaf
        for before, after in node.witness():
            at = op13.digest_of(before + at + after)
        assert at == root
    with pytest.raises(ValueError, match="aligned"):
        one = op13.Witnesses()
        one.append(leaves[0])
        one.append(leaves[1], 1)
