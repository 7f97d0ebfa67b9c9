import random
import re

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import components, ngram_join, textnum

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(docs):
    """Set size and component of each doc_id, by all pairs."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(docs):
    got = ngram_join.jaccard_components(docs).collect()
    assert len(got) == docs.count()
    want = brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_equals_all_pairs(corpus):
    check(corpus.select("doc_id", "text"))
    assert ngram_join.jaccard_components(corpus).columns == ["doc_id", "n_shingles", "component_id"]


def test_empty(empty):
    assert ngram_join.jaccard_components(empty).collect() == []


@pytest.mark.parametrize("edits", [0.02, 0.045, 0.06])
def test_one_large_group(spark, edits, monkeypatch):
    """A third of all rows are near copies around the threshold, so links are chains; small limits take every way of the join."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 40)
    monkeypatch.setattr(ngram_join, "LEAST_COUNT", 6)
    rng = random.Random(int(edits * 1000))
    base = invented(rng, 90).split()
    texts = [invented(rng, rng.randint(20, 80)) for _ in range(120)]
    for _ in range(110):
        w = list(base)
        for k in range(len(w)):
            if rng.random() < edits:
                w[k] = invented(rng, 1)
        texts.append(" ".join(w))
    common = invented(rng, 15)
    texts += [common + " " + invented(rng, 6) for _ in range(60)]
    check(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(6).select("doc_id", "text"))


def test_filters_lose_nothing():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.6, 1)], rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)]))
        if not len(b):
            continue
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        linked = 100 * both >= 75 * union
        assert textnum.jaccard_reaches(a, b) == linked
        if linked:
            assert ngram_join.near_enough(ngram_join.parity(a), len(a), ngram_join.parity(b), len(b), 75)
            none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            pa, pb = (ngram_join.ordered_prefix(s, *none, 75)[0] for s in (a, b))
            shared = np.intersect1d(pa, pb)
            assert len(shared)
            for t in shared:
                x, y = (np.flatnonzero(p == t) for p in (pa, pb))
                assert ngram_join.passing(np.array([len(a)]), x, np.array([len(b)]), y, 75).all()


def test_words_of_long_and_short_texts(monkeypatch):
    rng = random.Random(9)
    texts = [invented(rng, rng.randint(0, 50)) for _ in range(50)] + ["", None, "\t\n", "x" * 5000, invented(rng, 4000)]
    whole = {i: h.tolist() for i, _, _, h in textnum.words_of(texts)}
    monkeypatch.setattr(textnum, "CHUNK", 256)
    assert {i: h.tolist() for i, _, _, h in textnum.words_of(texts)} == whole
    for i, t in enumerate(texts):
        assert len(whole[i]) == len((t or "").split())
    assert len({h for w in whole.values() for h in w}) == len({w for t in texts for w in (t or "").split()})


@pytest.mark.parametrize("one_task", [10, 10**6])
def test_components(spark, one_task):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(5001, 5100)] + [(7, 7)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(pairs, "a long, b long").repartition(5), one_task)
    rows = got.collect()
    assert {r.node: r.component for r in rows} == {x: find(x) for x in linked} and len(rows) == len(linked)
    assert components.components(spark.createDataFrame([], "a long, b long"), one_task).count() == 0


def thue_morse(k, a="a", b="b"):
    for _ in range(k):
        a, b = a + b, b + a
    return a, b


def test_long_words_that_power_sums_confuse(spark):
    for k in (5, 6, 10, 11, 12):
        x, y = thue_morse(k)
        assert textnum.words(x.encode())[2] != textnum.words(y.encode())[2]
        assert textnum.words(x.upper().encode())[2] == textnum.words(x.encode())[2]
    x, y = thue_morse(11)
    check(spark.createDataFrame([(1, x), (2, y), (3, x.upper())], "doc_id long, text string"))


def test_rows_of_one_id_with_different_texts(spark):
    rng = random.Random(3)
    a, b = invented(rng, 40), invented(rng, 40)
    df = spark.createDataFrame([(5, a), (5, b), (5, a), (2, b), (9, a), (None, a), (7, None), (7, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df.repartition(4)).collect()), key=str)
    assert got == sorted([(5, 36, 5), (5, 36, 2), (5, 36, 5), (2, 36, 2), (9, 36, 5), (None, 36, None), (7, 0, 7), (7, 0, 7)], key=str)
