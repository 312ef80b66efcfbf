"""The corpus pipeline on a small folder of tables, stage by stage against plain forms, and its registration."""

import random

import brute
import pytest
from conftest import words

import corpus_pipeline

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, docs_of, tmp_path_factory):
    rng = random.Random(21)
    item = words(rng, 14, 300)
    base = words(rng, 70)
    rows = [(i, words(rng, rng.randrange(20, 200)), rng.choice(["a", "a", "a", "b", None])) for i in range(120)]
    rows += [(200 + i, " ".join(["spam"] * 30 + [f"&&&{rng.random()}" for _ in range(20)]), "b") for i in range(40)]
    rows += [(300, base, "a"), (301, base, "b"), (302, base + " end", "a"), (303, f"{words(rng, 30)} {item} {words(rng, 30)}", "a"), (304, "", "a"), (305, None, "b")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs_of(rows).withColumnRenamed("n_chars", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in [*range(0, 100), *range(200, 235)]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, item


def test_stages_against_plain_forms(spark, folder, tmp_path):
    path, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "mix", "write_tokens"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "write_tokens":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = [(r["doc_id"], r["text"]) for r in before.collect()] if name != "write_tokens" else None
        if name == "quality":
            good = {r["doc_id"] for r in docs.collect()}
            assert {i for i in range(120)} <= good and not good & set(range(200, 240))
        elif name == "near_dedup":
            alone = {i for i, (_, _, k) in brute.near_duplicates(kept[name], 5).items() if k}
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(alone)
        elif name == "decontaminate":
            clean = {r[0] for r in brute.contamination(kept[name], [(1, item)], 10) if not r[-1]}
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(clean) and 303 not in clean
        elif name == "mix":
            before = {i: t for i, t in kept[name]}
            assert all(" ".join(brute.words_of(r["text"])) in " ".join(brute.words_of(before[r["doc_id"]])) for r in docs.collect())
            sizes = {}
            for r in spark.read.parquet(str(tmp_path / "decontaminate")).collect():
                sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words_of(r["text"]))
            taken = {}
            for r in docs.collect():
                taken[r["source"]] = taken.get(r["source"], 0) + len(brute.words_of(r["text"]))
            assert all(abs(taken.get(s, 0) - t) <= max(256, 0.05 * t) for s, t in brute.targets(sizes).items())
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            mix = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(str(tmp_path / "mix")).collect()), key=lambda r: (r[0], r[1]))
            want = brute.token_rows(mix, lambda t: library.encode(t, add_special_tokens=False).ids)
            assert sorted(map(tuple, docs.collect())) == sorted(want)


def test_run_gives_what_the_stages_give(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_documents(spark, folder, tmp_path):
    path, _ = folder
    none = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, path).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names
