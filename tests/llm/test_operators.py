"""Each operator against its plain form, on small tables with nulls, empty and long texts, ties and repeated rows."""

import math
import random
import time
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import words
from pyspark.sql import functions as F

from quayside.llm import op1_minhash as op1
from quayside.llm import op2_cover_tree as op2
from quayside.llm import op3_decontaminate as op3
from quayside.llm import op4_mixing as op4
from quayside.llm import op5_token_files as op5
from quayside.llm import op6_token_counts as op6
from quayside.llm import op7_passages as op7
from quayside.llm import op8_quality as op8
from quayside.llm import op9_mix as op9
from quayside.llm import op10_suffixes as op10
from quayside.llm import ragged, repeats, tokens
from quayside.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def plain_sort(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, repeated words, odd white space, letters beyond ASCII; one long text."""
    rng = random.Random(7)
    base, passage = words(rng, 120), words(rng, 30)
    near = base.split()
    rows = [base, base, " ".join([*near[:60], "changed", *near[61:]]), " ".join(near[:95]), base.upper(), f"{base}\n\n{passage}", f"{words(rng, 40)} {passage} {words(rng, 20)}"]
    rows += [passage, "one", "one two", "One  Two", "", None, " \t\n", "the " * 90, "ab" * 150, "x" * 400, "ärger über straße " * 8, "日本 語 " * 30, words(rng, 9000), words(rng, 5)]
    rows += [" ".join(rng.sample(near, 100)) for _ in range(3)]
    return [(10 * i + 3, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def clashing(docs_of):
    """Adds columns that the operators use as names of their own."""

    def add(frame):
        names = "id alike row stats score hits key block starts n cell label word c0 _id _kept _piece size cluster".split()
        return frame.withColumns({x: F.lit(f"own {x}") for x in names})

    return add


# --- near duplicates


def test_minhash_equals_brute_force(docs_of, clashing, texts):
    for width in (4, 5):
        got = {r[0]: r[1:] for r in rows_of(op1.near_duplicates(clashing(docs_of(texts)), shingle=width))}
        assert got == brute.near_duplicates(texts, width)


def test_minhash_repeated_ids_null_ids_and_empty_table(docs_of):
    got = rows_of(op1.near_duplicates(docs_of([(4, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"), (5, "")])))
    assert plain_sort(got) == plain_sort([(4, 3, 4, True), (4, 3, 4, True), (9, 3, 4, False), (None, 3, None, True), (5, 0, 5, True)])
    assert rows_of(op1.near_duplicates(docs_of([]))) == []


def test_minhash_large_cluster_goes_through_blocks(docs_of, monkeypatch):
    rng = random.Random(3)
    base = words(rng, 60, 10_000).split()
    rows = []
    for i in range(60):
        changed = list(base)
        for _ in range(rng.randrange(0, 6)):
            changed[rng.randrange(60)] = f"n{rng.randrange(10_000)}"
        rows.append((i, " ".join(changed[: 60 - rng.randrange(0, 12)])))
    monkeypatch.setattr(op1, "BLOCK", 8)
    got = {r[0]: r[1:] for r in rows_of(op1.near_duplicates(docs_of(rows)))}
    assert got == brute.near_duplicates(rows, 4)


def test_blocks_count_common_values():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(50)]
    want = [[100 * len(np.intersect1d(a, b)) >= 50 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (op1.linked_pairs(sets, 50) == np.array(want)).all()


def test_deduplicated_keeps_columns(docs_of, clashing, texts):
    docs = clashing(docs_of([*texts, (None, "no id"), (texts[0][0], texts[0][1])]))
    kept = op1.deduplicated(docs, shingle=5)
    want = sorted(i for i, (_, _, k) in brute.near_duplicates(texts, 5).items() if k)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in rows_of(kept) if r[0] is not None) == want
    assert kept.where("doc_id IS NULL").count() == 1


def vectors(rng, n, dims):
    rows = []
    for i in range(n):
        v = rng.normal(size=dims) if i % 3 or not rows else np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=dims) * rng.choice([0, 0.02, 0.06])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("cell", [2048, 10])
def test_cover_tree_equals_brute_force(spark, monkeypatch, cell):
    rows = vectors(np.random.default_rng(5), 160, 8)
    rows += [(500, rows[0][1], rows[0][2]), (501, [2 * x for x in rows[0][1]], rows[0][2]), (502, None, 1), (503, [0.0] * 8, 1), (504, [1.0, None] * 4, 1), (505, [float("nan")] * 8, 1), (506, rows[1][1], None)]
    rows += [(507, [], 1), (508, [1.0, 2.0], 1), (509, [1.0, 2.0], 1)]
    monkeypatch.setattr(op2, "CELL", cell)
    monkeypatch.setattr(op2, "LEAF", 4)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("own")).withColumn("class", F.lit(1))
    assert {r[0]: r[1:] for r in rows_of(op2.near_duplicates(frame))} == brute.vector_links(rows, 0.98)


def test_cover_tree_ids_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (7, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)]
    got = plain_sort(rows_of(op2.near_duplicates(spark.createDataFrame(rows, schema))))
    assert got == plain_sort([(3, 2, 3, True), (3, 2, 3, True), (7, 2, 3, False), (None, 0, None, True)])
    assert rows_of(op2.near_duplicates(spark.createDataFrame([], schema))) == []


def test_cover_tree_covers():
    points = np.random.default_rng(2).normal(size=(300, 5))
    points /= np.linalg.norm(points, axis=1)[:, None]
    todo, seen = [op2.cover_tree(points)], 0
    while todo:
        node = todo.pop()
        assert np.linalg.norm(points[node.members] - node.centre, axis=1).max() <= node.radius + 1e-12
        assert all(c.radius <= max(node.radius, 1e-9) for c in node.children)
        seen += 0 if node.children else len(node.members)
        todo += node.children
    assert seen == 300


def test_cover_tree_of_rescaled_copies(spark):
    """Copies that differ by rounding only lie nearer than computed distances can tell."""
    rng = np.random.default_rng(3)
    one = rng.normal(size=16)
    rows = [(i, [float(x) for x in np.float32(one * s)], 1) for i, s in enumerate(rng.uniform(0.1, 10, 2000))]
    points = np.array([v for _, v, _ in rows])
    op2.cover_tree(points / np.linalg.norm(points, axis=1)[:, None])
    got = rows_of(op2.near_duplicates(spark.createDataFrame(rows[:100], "vec_id long, embedding array<float>, label int")))
    assert plain_sort(got) == plain_sort([(i, 99, 0, i == 0) for i in range(100)])


# --- decontamination


def test_decontamination_equals_brute_force(spark, docs_of, clashing):
    rng = random.Random(11)
    items = [(i, words(rng, n, 50)) for i, n in enumerate([30, 12, 10, 4, 1, 25])] + [(6, None), (7, "..."), (None, "w1 w2"), (2, "Again, Über-Maß 12"), (9, "w3 w4")]
    docs = [(i, words(rng, 60, 50)) for i in range(8)]
    docs += [(20, f"Start! {items[0][1].upper().replace(' ', ' -- ')} end"), (21, f"{items[3][1]}."), (22, None), (23, ""), (24, "x again über maß 12 y"), (25, items[1][1] + items[2][1]), (24, "x")]
    docs += [(26, f"{items[0][1]} {items[0][1]}")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(1))
    for block in (1 << 20, 200):  # one block of items, and many
        found = op3.marked(clashing(docs_of(docs)), bench, block_bytes=block)
        digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
        got = found.select("row.doc_id", "n_words", "n_hit", F.size("item_ids"), digest, F.col("n_hit") > 0)
        assert plain_sort(rows_of(got)) == plain_sort(brute.contamination(docs, items, 10))


def test_decontamination_offsets_and_stage(spark, docs_of):
    bench = spark.createDataFrame([(1, "straße nummer eins")], "item_id long, text string")
    docs = docs_of([(1, "Die Große STRAßE, Nummer: eins. Ende"), (2, "nichts"), (3, None)])
    (hit,) = op3.marked(docs, bench).where("n_hit > 0").collect()
    (span,) = hit["hits"]
    assert hit["text"][span["start"] : span["end"]] == "STRAßE, Nummer: eins"
    kept = op3.decontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert op3.decontaminated(docs, bench.where("false")).count() == 3
    assert op3.marked(docs.where("false"), bench).count() == 0


def test_a_window_of_many_items_is_cut_into_blocks(spark, docs_of):
    items = [(f"i{i}", "same few words " + ("" if i % 2 else f"and{i}")) for i in range(400)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    blocks = list(op3._blocks(bench.repartition(3), 10, 8000))
    assert len(blocks) > op3.STEPS and all(sum(map(len, b.values())) * op3.ID_BYTES < 8000 + op3.ID_BYTES for b in blocks)
    docs = [(1, "here: same few words and2"), (2, "same few"), (3, None)]
    got = rows_of(op3.marked(docs_of(docs), bench, block_bytes=8000).select("row.doc_id", "n_hit", F.size("item_ids")))
    assert plain_sort(got) == [(1, 4, 201), (2, 0, 0), (3, 0, 0)]


def test_spellings_match_whole_words_only():
    for n in (1, 63, 64, 65, 5000):
        spelled, other = op3.spelling([str(i).encode() for i in range(n)])
        assert len(set(spelled.values())) == n and {len(x) for x in spelled.values()} == {len(other)}
        assert not {x[0] for x in spelled.values()} & {c for x in [other, *spelled.values()] for c in [*x[1:], other[0]]}


# --- scoring


def test_scores(docs_of, clashing, texts, monkeypatch):
    rows = [*texts, (None, "one more text"), (3, texts[0][1]), (3, "another under its id")]
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    want = plain_sort((i, n, k, t, round(b, 6)) for i, _, n, k, t, b in brute.base_scores(rows))
    for frequent in (1000, 3, 0):  # most words broadcast, or joined
        got = [tuple(r) for r in op4.scored(clashing(docs_of(rows)), fold, frequent).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
        assert plain_sort((*r[:4], round(r[4], 6)) for r in got) == want
        assert all(r[5] < 0 for r in got)
    assert op4.scored(docs_of([]), fold).count() == 0
    alone = op4.scored(docs_of([(1, "never learned")]), F.lit(True)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in alone] == [(3, 0, 0)]


def test_spelling_adds_up_to_one():
    """Over all words of up to two letters of a byte alphabet, and what is longer: the mass of the first bytes is one."""
    model = op4.Spelling.empty()
    rng = np.random.default_rng(1)
    model = model._replace(zeros=rng.random(model.zeros.shape, np.float32) * 5, ones=rng.random(model.ones.shape, np.float32) * 5)
    # the mass of a byte is the product over its bits, so that of all first bytes is one: words of one byte, ended or not
    mass = 0.0
    for b in range(256):
        text, _, context = op4.events(np.array([b], np.uint8), np.array([0, 1]))
        p = 1.0
        for k, places, bit in op4.bits(text[:1], context[:, :1]):
            one = float(model.refined(model.mixed(places)[1 + 1], k)[0])
            p *= one if bit[0] else 1 - one
        mass += p
    assert abs(mass - 1) < 1e-9


def test_nodes_without_their_event():
    """Prepared nodes give what each event gives by itself, taken out of its own counts."""
    rng = np.random.default_rng(3)
    zeros, ones = rng.integers(0, 4, (2, 50)).astype(float)
    model = op4.Spelling.empty()._replace(zeros=zeros, ones=ones)
    places, bit = rng.integers(0, 50, (op4.PREDICTORS, 200)), rng.integers(0, 2, 200).astype(np.uint8)
    for one in (None, bit):
        n0, n1 = zeros[places], ones[places]
        if one is not None:
            n0, n1 = np.maximum(n0 - (one == 0), 0), np.maximum(n1 - (one == 1), 0)
        for now in (model, model.prepared(one is not None)):
            inputs, gate, _ = now.mixed(places, one)
            assert np.allclose(inputs[:-1], np.clip(np.log((n1 + 0.1) / (n0 + 0.1)), -9, 9))
            assert gate.min() >= 0 and gate.max() < op4.GATES


def test_draws_are_unfolded_by_many_tasks(spark, docs_of):
    """Rows that unfold to draws or slots aren't merged by their bytes into a few tasks."""
    docs = docs_of([(i, "a b c", "xyz"[i % 3]) for i in range(30)])
    plan = op9.mix_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2


def test_scores_learn(docs_of):
    """Held-out texts score better than by counted words alone."""
    rng = random.Random(2)
    kinds = [["".join(rng.choices(parts, k=rng.choice([1, 2, 3]))) for _ in range(500)] for parts in ("the an er tion ing ed re".split(), "ón os de la ción mente ña".split())]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=80))) for i in range(300)]
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    held = op4.scored(docs_of(rows), fold).where(fold)
    base, score = held.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_scores_read_the_text(docs_of):
    """The order of the words counts, across their borders, and the bits per byte are those of the score."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha beta", "gamma delta", "omega sigma"]) for _ in range(30))) for i in range(60)]
    held = [(100, rows[0][1]), (101, " ".join(sorted(rows[0][1].split()))), (102, "")]
    got = {r["doc_id"]: r for r in op4.scored(docs_of([*rows, *held]), F.col("doc_id") >= 100).collect()}
    assert abs(got[100]["base_score"] - got[101]["base_score"]) < 1e-9
    assert got[100]["score"] > got[101]["score"] + 5
    assert abs(got[100]["bits_per_byte"] * len(rows[0][1]) + got[100]["score"] * np.log2(10)) < 1e-6
    assert got[102]["bits_per_byte"] is None


def test_event_counts_are_exact(spark, docs_of, monkeypatch):
    """Counts at all nodes of all contexts are those of a plain dictionary, over packs and tasks."""
    monkeypatch.setattr(op4, "CHUNK", 300)
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab c\0é", k=rng.randrange(1, 80))) + " longerword longerwords" for _ in range(90)] + ["", "x"]
    plain = {}
    for t in texts:
        t = t.encode()
        for i, byte in enumerate(t):
            begin = max([j + 1 for j in range(i) if t[j] in b" \t\n\v\f\r"], default=0)
            for o, context in enumerate([*((min(i, n), t[max(0, i - n) : i]) for n in op4.ORDERS), t[max(begin, i - 6) : i]]):
                for k in range(8):
                    key = (o, context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1)
                    plain[key] = plain.get(key, 0) + 1
    frame = docs_of([(i, t) for i, t in enumerate(texts)]).select("text", F.lit(False).alias("held_out")).repartition(3)
    events = frame.mapInArrow(op4.counted, "gram long, n long, f long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("f").alias("f"))
    rows = list(op4.packs(iter(events.sort(F.expr(op4._NEAR)).toArrow().to_batches(100))))
    short, got, packs = op4._short(spark.createDataFrame(pa.Table.from_batches(rows))), [], 0
    for pack in op4._packs(iter(rows)):
        numbers, model = op4.known(pack, short, op4.Spelling.empty())
        packs += 1
        for k, places, bit in op4.bits(pack.byte, numbers):
            for o in range(op4.PREDICTORS):
                table = np.stack([model.zeros, model.ones])
                got += list(zip([o] * len(bit), table[bit.astype(int), places[o]].tolist(), pack.n.tolist(), strict=True))
    # the sum over all events of the count of what came true: the sum of squares of the plain counts
    for o in range(op4.PREDICTORS):
        assert sum(c * n for i, c, n in got if i == o) == sum(v * v for key, v in plain.items() if key[0] == o)
    assert packs > 3


def test_frequent_keys_are_found_without_order():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 300):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), np.arange(n, dtype=np.uint64), ~np.arange(n // 2, dtype=np.uint64)]))
        table = op4.Frequent(keys, (), 1).opened()
        asked = np.concatenate([rng.permutation(keys), rng.integers(0, 2**64, 50, np.uint64), np.array([0, 2**63, 2**64 - 1], np.uint64)])
        at, hit = table.places(asked)
        assert hit.tolist() == [k in set(keys.tolist()) for k in asked.tolist()]
        assert (keys[at[hit]] == asked[hit]).all()


def test_frequent_events_are_summed_without_sorting(monkeypatch):
    """Only what the broadcast tables lack is put in order."""
    texts = ["the same words, once more"] * 50 + ["", None, "rare"]
    raw, offs = ragged.flat(pa.array(texts))
    common = np.sort(ragged.mix(np.unique(op4.grams(raw, offs)[: offs[50]])))
    events = op4.Frequent(common, (np.arange(len(common)) * -0.5,), 1)
    words = op4.Frequent(np.zeros(0, np.uint64), (np.zeros(0), np.zeros(0)), 1)
    n = len(texts)
    rows = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts)], names=["id", "alike", "text"])
    ordered, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *rest, **more: ordered.append(len(x)) or argsort(x, *rest, **more))
    got = pa.Table.from_batches(op4._texts(SimpleNamespace(value=words), SimpleNamespace(value=events), op4.Counts(0, 0, 0, 0))(iter([rows]))).to_pylist()
    assert sum(ordered) < len(raw) // 2
    own = {r["id"]: r for r in got if r["rows"]}
    key = {k: v for k, v in zip(common.tolist(), events.values[0].tolist(), strict=True)}
    grams = ragged.mix(op4.grams(raw, offs)).tolist()
    for i in range(n):
        want = sum(key.get(g, 0) for g in grams[offs[i] : offs[i + 1]]) + (offs[i + 1] - offs[i] + 1) * math.log10(0.5)
        assert abs(own[i]["score"] - want) < 1e-9
        assert sum(r["n"] for r in got if r["id"] == i) == len((texts[i] or "").split()) + sum(g not in key for g in grams[offs[i] : offs[i + 1]])


# --- tokens


def test_pieces_met_again_stay_known(monkeypatch):
    """When a worker holds too many pieces, frequent ones aren't encoded anew; ids stay those of the library."""
    monkeypatch.setattr(tokens, "KEPT", 150)
    rng = random.Random(9)
    common = ["often", "these, words", "être", "12 again!", "\ttab "]
    slices = [[" ".join([*common, *("".join(rng.choices("abcdé'9.", k=9)) for _ in range(20))]) for _ in range(4)] for _ in range(30)]
    library = tokens.BytePieces(public_tokenizers.path("byte_bpe_50k.json"))
    learned, learn = [], library._learn
    monkeypatch.setattr(library, "_learn", lambda pieces, *rest: learned.extend(pieces) or learn(pieces, *rest))
    sizes = []
    for texts in slices:
        ids, offs = library.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[offs[i] : offs[i + 1]].tolist() == library.library.encode(t, add_special_tokens=False).ids
        sizes.append(len(library.place))
    assert learned.count(b" words") == learned.count(" être".encode()) == 1
    assert len(learned) > 1000 and max(sizes) < 500
    # beyond half of them, all are forgotten
    library.again[: len(library.place)] = True
    library._trim()
    assert not library.place


def test_new_words_are_encoded_as_one_text(monkeypatch):
    """A text of many words gives each word's ids, and words that tokens go over are encoded alone."""
    monkeypatch.setattr(tokens, "TOGETHER", 7)
    library = tokens.BytePieces(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(10)
    words = [(" " + "".join(rng.choices("theinrsé'9.,日\u0301", k=rng.randrange(1, 12)))).encode() for _ in range(300)]
    for some in ([], words[:1], words, [b" a", b"b", b" c"], [b" th", b"e"]):
        want = [library.library.encode(w.decode(), add_special_tokens=False).ids for w in some]
        ids, lengths = library._together(some)
        assert lengths.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_token_files_round_trip(spark, docs_of, clashing, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [(1, "a<|endoftext|>b"), (2, "x\x1cy\x1fz   ​"), (2, "a second text"), (4, "it's  12 3's\r\n"), (5, "z" * 1000), (None, "last")]
    rows = sorted([*texts, *odd], key=lambda r: (r[0] is None, r[0], r[1] or ""))
    want = brute.token_rows(rows, lambda t: library.encode(t, add_special_tokens=False).ids)
    docs = clashing(docs_of(random.Random(1).sample(rows, len(rows))))
    path = scratch_path(spark, "tokens")
    op5.write_segments(docs, public_tokenizers.path("byte_bpe_50k.json"), path, segment_ids=500)
    assert plain_sort(rows_of(op5.read_digests(spark, path))) == plain_sort(want)
    assert spark.read.parquet(path).where("n_docs > 1").count() > 0
    assert op5.token_files(spark, docs_of([])).count() == 0


def test_boundaries_select():
    rng = random.Random(4)
    for n, top in ((1, 1), (7, 9), (1000, 5_000_000), (2000, 2000), (600, 700)):
        values = np.array(sorted(rng.choices(range(top + 1), k=n)))
        code = op5.Boundaries.encoded(values)
        assert (code.all() == values).all()
        assert [code.select(i) for i in range(n)] == values.tolist()
        assert len(code.low) + len(code.high) <= n * (2 + max(1, top // n).bit_length()) / 8 + 4


def test_token_counts_equal_the_library(docs_of, clashing, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    odd = ["<s>a</s><unk><0x41>", "▁a ▁▁b", "a" * 700, "ab" * 700, " " * 90, "\u0000́🎉 é", *("".join(rng.choices(" \taeinsté日▁.", k=rng.randrange(40))) for _ in range(300))]
    rows = [*texts, *((1000 + i, t) for i, t in enumerate(odd)), (None, "x"), (3, "again")]
    got = rows_of(op6.token_counts(clashing(docs_of(rows)), limit=300))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 300) for i, t in rows]
    assert plain_sort(got) == plain_sort(want)


def test_long_pieces_equal_the_library(docs_of, texts):
    import base64
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(16)
    glued = "".join(t for _, t in texts if t).replace(" ", "")
    long = [glued, "there" * 2000, "aab" * 3000, base64.b64encode(rng.randbytes(30_000)).decode(), "▁".join(glued[i : i + 900] for i in range(0, 9000, 900)), "\0" * 600 + glued[:500]]
    long += ["".join(rng.choices(letters, k=3000)) for letters in ("the ni", "there", "aeinst", "ABCabc12", "=-_", "日本語のはab") for _ in range(4)]
    rows = [*enumerate(long), *((1000 + i, t) for i, t in texts if i is not None)]
    got = rows_of(op6.token_counts(docs_of(rows)))
    assert plain_sort((r[0], r[2]) for r in got) == plain_sort((i, len(library.encode(t or ""))) for i, t in rows)
    assert op6.token_counts(docs_of([])).count() == 0


def test_a_megabyte_without_spaces_takes_seconds():
    rng = random.Random(17)
    syllables = [a + b for a in "bcdfghlmnprstvw" for b in "aeiou"]
    text = "".join(rng.choices(syllables, k=500_000))
    merges = op6.Merges.of(public_tokenizers.path("piece_bpe_32k.model"))
    begin = time.process_time()
    merges.count(pa.array([text]))
    assert time.process_time() - begin < 60


# --- passages


@pytest.mark.parametrize("hot", [None, 1])
def test_passages_equal_brute_force(docs_of, clashing, texts, monkeypatch, hot):
    if hot:  # all minimisers are dealt window by window
        monkeypatch.setattr(repeats, "SAMPLE", 1)
        monkeypatch.setattr(repeats, "HOT_LEAST", hot)
        monkeypatch.setattr(repeats, "HOT_SHARE", 0.0)
    rows = [*texts, (None, texts[5][1]), (None, texts[6][1]), (13, texts[5][1]), (13, texts[5][1])]
    got = rows_of(op7.without_repeats(clashing(docs_of(rows))))
    assert plain_sort(got) == plain_sort(brute.passages(rows, 13))
    assert op7.without_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("hot", [None, 1, 3])
def test_byte_strings_equal_brute_force(docs_of, clashing, texts, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "SAMPLE", 1)
        monkeypatch.setattr(repeats, "HOT_LEAST", hot)
        monkeypatch.setattr(repeats, "HOT_SHARE", 0.0)
    rows = [*texts, (None, texts[5][1] + " " + texts[14][1])]
    got = rows_of(op10.without_repeats(clashing(docs_of(rows))))
    assert plain_sort(got) == plain_sort(brute.byte_strings(rows, 100))
    # a row that stands twice is answered twice alike
    twice = rows_of(op10.without_repeats(docs_of([*rows, rows[0]])))
    assert plain_sort(twice) == plain_sort([*got, next(r for r in got if r[0] == rows[0][0])])
    assert op10.without_repeats(docs_of([])).count() == 0


def test_suffixes_agree_as_far_as_bounded():
    rng = random.Random(8)
    text = "".join(rng.choices("ab", k=300)) * 2
    buf = np.frombuffer(text.encode(), np.uint8)
    at = np.arange(0, 480, 7)
    bound = op10.agreement(buf, at, np.zeros(len(at), np.int64), 100)

    def agree(a, b):
        n = 0
        while n < 100 and text[a + n : a + n + 1] == text[b + n : b + n + 1] != "":
            n += 1
        return n

    for i, a in enumerate(at):
        assert bound[i] >= max(agree(a, b) for j, b in enumerate(at) if j != i)


# --- quality


def test_quality_learns_and_holds_out(spark, docs_of, clashing):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        rows.append((i, words(rng, 80) if good else " ".join(["spam"] * 40 + [f"&&&{rng.random()}" for _ in range(20)])))
        labels.append((i, int(good), 0))
    marks = spark.createDataFrame([*labels[:300], (0, None, 0), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    odd = [(1000, None), (1001, ""), (None, "no id"), (5, "twice"), (1002, words(rng, 20_000))]
    docs = clashing(docs_of([*rows, *odd]))
    found = op8.scored(docs, op8.fit(docs, marks)).select("row.doc_id", "score", "row.score").toDF("doc_id", "score", "own").collect()
    assert len(found) == 405 and all(0 <= r["score"] <= 1 and r["own"] == "own score" for r in found)
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 4 > 0) for r in found if r["doc_id"] is not None and 300 <= r["doc_id"] < 400]
    assert sum(right) >= 98
    kept = op8.accepted(docs, marks)
    assert kept.columns == docs.columns and 290 <= kept.count() <= 310
    assert {r["score"] for r in op8.scored(docs, op8.fit(docs, marks.where("false"))).collect()} == {0.5}
    assert op8.accepted(docs.where("false"), marks).count() == 0


def test_isotonic_never_goes_down():
    raw, share = op8.isotonic(np.array([[0, 1, 0.5], [1, 1, 0.1], [2, 2, 0.4], [3, 1, 0.2], [4, 5, 0.9]]))
    assert (np.diff(share) >= 0).all() and (np.diff(raw) > 0).all()


# --- mixing


def test_mix_meets_targets(docs_of, clashing):
    rng = random.Random(10)
    rows = [(i, words(rng, rng.randrange(1, 900)), rng.choice(["b", "b", "b", "a", None, "Z"])) for i in range(120)]
    rows += [(200, None, "a"), (201, " \n", "empty"), (202, " lead and end ", "tiny"), (None, words(rng, 50), "b"), (7, rows[7][1], rows[7][2]), (203, words(rng, 20_000), "a")]
    docs = clashing(docs_of(rows))
    got = rows_of(op9.mix_report(docs))
    assert plain_sort((r[0], r[1]) for r in got) == plain_sort((i, len(brute.words_of(t))) for i, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words_of(t))
    want = brute.targets(sizes)
    taken, by_id = {}, {r[0]: r[2] for r in rows}
    for doc_id, size, source_size, target, words_taken in got:
        source = by_id[doc_id]
        assert source_size == sizes[source] and abs(target - want[source]) < 1e-6 and 0 <= words_taken <= 3 * size
        taken[source] = taken.get(source, 0) + words_taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(2 * op9.BLOCK, 0.02 * want[s])
    assert plain_sort(got) == plain_sort(rows_of(op9.mix_report(docs.repartition(3))))
    assert op9.mix_report(docs_of([])).count() == 0


def test_mixed_rows_hold_what_the_report_says(docs_of, clashing):
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randrange(1, 700)), rng.choice("aaab")) for i in range(60)]
    docs = clashing(docs_of([*rows, (100, None, "a"), (101, "", "b")]))
    mix = op9.mixed(docs)
    assert mix.columns == docs.columns
    got = {}
    for r in mix.select("doc_id", "text", "n_chars", "key").collect():
        got[r[0]] = got.get(r[0], 0) + len(brute.words_of(r[1]))
        assert r[2] == len(r[1]) and r[3] == "own key" and r[1] in " ".join(brute.words_of(dict((x[0], x[1]) for x in rows)[r[0]]))
    assert got == {r[0]: r[4] for r in rows_of(op9.mix_report(docs)) if r[4]}


def test_permutations_are_bijections(spark):
    sizes = [*range(1, 60), 63, 64, 99, 126, 1000, 4097]
    table = spark.createDataFrame([(n, seed) for n in sizes for seed in (1, 2)], "n long, seed long").withColumn("i", F.expr("explode(sequence(0L, n - 1))"))
    rows = rows_of(table.select("n", "seed", "i", op9.permuted(F.col("i"), F.col("n"), F.col("seed")).alias("to")))
    to = {}
    for n, seed, i, x in rows:
        to.setdefault((n, seed), {})[i] = x
    for (n, seed), m in to.items():
        assert sorted(m.values()) == list(range(n)) and m == {i: brute.permuted(i, n, seed) for i in range(n)}
        if n > 20:  # no rotation, and no other for another seed's sake
            assert len({(m[i] - i) % n for i in m}) > n // 3 and m != to[n, 3 - seed]


def test_packed_mix_equals_brute_force(spark, docs_of, clashing, monkeypatch):
    monkeypatch.setattr(op9, "SHARD", 16)
    monkeypatch.setattr(op9, "GROUP", 2)
    rng = random.Random(13)
    rows = [(i, words(rng, rng.randrange(0, 900)), rng.choice(["b", "b", "b", "a", None, "Z"])) for i in range(90)]
    rows += [(200, None, "a"), (201, " \n", "empty"), (202, " lead and\tend ", "tiny"), (None, words(rng, 300), "b"), (7, rows[7][1], rows[7][2]), (203, words(rng, 9000), "a")]
    docs = clashing(docs_of(rows))
    chunks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = brute.packed_mix(rows, op9.BLOCK, 16, chunks)
    assert len({r[0] for r in want}) > 4
    assert plain_sort(rows_of(op9.packed(docs))) == plain_sort(want)
    # a shard's slots are numbered without gaps, and the report counts the same slots
    for shard in {r[0] for r in want}:
        mine = sorted(r[1] for r in want if r[0] == shard)
        assert mine == list(range(len(mine)))
    report = rows_of(op9.mix_report(docs, slots=True))
    assert sum(r[4] for r in report) == sum(r[4] for r in want)
    assert {r[6:] for r in report if r[4]} <= {(r[0], r[1]) for r in want} and all((r[5] > 0) == (r[4] > 0) == (r[6] is not None) for r in report)
    path = f"{scratch_path(spark, 'shards')}"
    op9.write_shards(docs, path)
    assert spark.read.parquet(path).count() == len(want)
    assert op9.packed(docs_of([])).count() == 0


def test_mix_is_native(docs_of):
    for frame in (op9.mix_report(docs_of([(1, "a b", "x")]), slots=True), op9.packed(docs_of([(1, "a b", "x")])), op9.mixed(docs_of([(1, "a b", "x")]))):
        plan = frame._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_ragged_words_stay_in_their_text():
    from quayside.llm import ragged

    column = pa.array(["a b", None, "", "c", " d\n", "e"])
    buf, offs = ragged.flat(column.slice(1))
    w = ragged.words(buf, offs)
    assert w.first.tolist() == [0, 0, 0, 1, 2, 3] and [bytes(buf[a:b]) for a, b in zip(w.start, w.end, strict=True)] == [b"c", b"d", b"e"]


def test_groups_hold_whole_minimisers():
    rng = np.random.default_rng(8)
    key, lengths = rng.integers(0, 40, 500), rng.integers(1, 30, 500)
    for limit in (1, 100, 2000, 1 << 20):
        found = list(repeats.groups(key, lengths, limit))
        assert sorted(np.concatenate(found).tolist()) == list(range(500))
        kinds = [set(key[g].tolist()) for g in found]
        assert sum(map(len, kinds)) == 40  # no minimiser in two groups
        assert all(len(k) == 1 or lengths[g].sum() <= limit for k, g in zip(kinds, found, strict=True))
    assert list(repeats.groups(key[:0], lengths[:0])) == []
