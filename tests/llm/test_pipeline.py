import random

import pytest

from tests.llm.conftest import SCHEMA, invented
from tests.llm.test_ngram_join import brute_force

corpus_pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def sf(spark, tmp_path):
    rng = random.Random(12)
    texts, kind, labels = {}, {}, []
    passage, item = invented(rng, 60), invented(rng, 30)
    for i in range(400):
        texts[i], kind[i] = invented(rng, rng.randint(60, 140)), "clean"
        if i % 8 == 0:
            w = texts[i].split()
            w[5:5] = ["zzbad", "zzworse", "zzvile"]
            texts[i], kind[i] = " ".join(w), "toxic"
        elif i % 8 == 1 and i > 100:
            texts[i], kind[i] = texts[i - 98].replace("a", "a"), "copy"
        elif i % 8 == 3:
            w = texts[i].split()
            texts[i], kind[i] = " ".join([*w[:20], passage, *w[20:]]), "passage"
        elif i % 8 == 5:
            w = texts[i].split()
            texts[i], kind[i] = " ".join([*w[:9], item, *w[9:]]), "leak"
        if i % 3:
            labels.append((i, 1, int(kind[i] == "toxic")))
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, invented(rng, 70), "en", "s", 9)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item), (1, invented(rng, 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts, kind, passage, item


def test_stages_and_run(spark, sf):
    sf_dir, texts, kind, passage, item = sf
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir), name)
        if name == "packing":
            break
        assert docs.columns == COLUMNS
        after = {r.doc_id: r.text for r in docs.collect()}
        kept.append(after)
        assert {1000, 1001, None} <= set(after)
        if name == "toxicity":
            assert {i for i in before if i not in after} == {i for i in kind if kind[i] == "toxic"}
        if name == "ngram_jaccard_join":
            want = brute_force(before.items())
            assert set(after) - {None} == {i for i, (_, c) in want.items() if i == c}
        if name == "substring_dedup":
            assert set(after) == set(before) and sum(passage in (t or "") for t in after.values()) == 1
            assert all(after[i] == before[i] for i in after if kind.get(i) == "clean")
        if name == "benchmark_decontamination":
            assert {i for i in before if i not in after} == {i for i in before if before[i] and item in before[i]}
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids == set(kept[-1])
    whole = [(r.doc_id, r.doc_tokens, r.length) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert {(d, n) for d, n, _ in whole} == {(r.doc_id, r.doc_tokens) for r in docs.collect()}  # cut points depend on the files' order
    assert sum(n for *_, n in whole) == sum(n for n in {d: n for d, n, _ in whole}.values())


def test_repeated_rows_of_a_document(spark, sf):
    sf_dir = sf[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.keep_one_of_each_group(spark, docs.union(docs.where("doc_id in (2, 4)")), sf_dir)
    assert out.where("doc_id in (2, 4)").count() == 2 and out.columns == docs.columns


def test_empty(spark, empty, sf):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf[0])
    assert docs.collect() == []
