import random

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import substring_dedup as sd
from tidemark.llm.textnum import encode, jaccard_reaches, runs, shingle_set, words


def repeats(texts, width):
    """Documents with a run of `width` words that an earlier document has."""
    first, found = {}, set()
    for i in sorted(texts):
        w = (texts[i] or "").lower().split()
        for k in range(len(w) - width + 1):
            if first.setdefault(tuple(w[k : k + width]), i) != i:
                found.add(i)
    return found


@pytest.fixture
def planted(spark):
    rng = random.Random(8)
    passages = [invented(rng, n) for n in (51, 55, 70, 190)]
    texts = {}
    for i in range(80):
        own = invented(rng, rng.randint(5, 120)).split()
        if i % 2:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passages[i // 2 % 4].split()
        texts[i] = " ".join(own)
    line = invented(rng, 60).split()
    for i in range(80, 90):  # paragraphs that differ in two words
        other = list(line)
        for _ in range(1):
            other[rng.randrange(60)] = "changed"
        texts[i] = invented(rng, 30) + "\n" + " ".join(other) + "\n" + invented(rng, 10)
    return texts, spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA)


def test_every_passage_is_found(planted):
    texts, docs = planted
    got = sd.repeated_passages(docs.repartition(5)).collect()
    removed = {r.doc_id for r in got if r.removed}
    assert repeats(texts, 51) <= removed
    clean = {i for i in texts if i % 2 == 0 and i < 80}
    assert not clean & {r.doc_id for r in got}
    assert len(removed & set(range(80, 90))) >= 8
    for r in got:
        assert 0 <= r.start and r.start + r.n_chars <= len(texts[r.doc_id]) and r.first_doc <= r.doc_id
    classes = {r.doc_id: r.class_id for r in got if r.doc_id < 80}
    for k in range(4):
        assert len({c for i, c in classes.items() if i // 2 % 4 == k}) == 1


def test_first_copy_stays(planted):
    texts, docs = planted
    out = {r.doc_id: r.text for r in sd.without_repeats(docs).collect()}
    assert not repeats(out, 51)
    for i in range(0, 80, 2):
        assert out[i] == texts[i]
    for k in (1, 3, 5, 7):
        assert out[k] == texts[k]
    assert all(len(out[i].split()) >= len(texts[i].split()) - 200 for i in out)


def test_odd_rows(corpus, empty):
    before = corpus.count()
    out = sd.without_repeats(corpus)
    assert out.columns == corpus.columns
    rows = out.collect()
    assert len(rows) <= before and sum(r.doc_id is None for r in rows) == 2
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None and r.doc_id is not None and r.n_chars != 5)
    assert sd.repeated_passages(empty).collect() == [] and sd.without_repeats(empty).collect() == []


def test_anchors_are_guaranteed():
    rng = random.Random(1)
    for _ in range(50):
        shared = invented(rng, 49)
        a, b = (words(encode(invented(rng, rng.randint(0, 80)) + " " + shared + " " + invented(rng, rng.randint(0, 80))))[2] for _ in range(2))
        x, y = (sd.entries(1, b"", np.zeros(len(h), np.int64), h)["k"] if len(h) >= sd.LEAST else np.zeros(0, np.uint64) for h in (a, b))
        if len(a) >= sd.LEAST and len(b) >= sd.LEAST:
            assert len(np.intersect1d(x, y))


def test_recall_of_bands():
    assert 1 - (1 - 0.75**sd.ROWS) ** sd.BANDS > 0.99
    rng = random.Random(6)
    met = total = 0
    for _ in range(200):
        base = invented(rng, 80).split()
        other = list(base)
        for _ in range(2):
            other[rng.randrange(80)] = "new"
        keys = [sd.line_keys(words(encode(" ".join(w)))[2], np.array([0]), np.array([80]))[0] for w in (base, other)]
        total += 1
        met += bool((keys[0] == keys[1]).any())
    assert met / total > 0.97


def test_every_place_in_a_later_document_goes(spark):
    rng = random.Random(21)
    passage, line = invented(rng, 60), invented(rng, 60)
    near = " ".join([*line.split()[:30], "changed", *line.split()[31:]])
    own = [invented(rng, 30) for _ in range(9)]
    texts = {
        1: f"{own[0]} {passage} {own[1]}\n{line}\n{own[2]}",
        2: f"{own[3]} {passage} {own[4]} {passage} {own[5]} {passage}",
        3: f"{own[6]}\n{near}\n{own[7]}\n{near}\n{own[8]}",
        4: "de " * 400,
        5: "de " * 900,
    }
    for parts in (1, 3):  # documents of one scope, and of several
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA).repartition(parts)
        out = {r.doc_id: r.text for r in sd.without_repeats(docs).collect()}
        assert out[1] == texts[1] and out[4] == texts[4] and 5 not in out
        assert out[2].split() == " ".join(own[3:6]).split()
        assert out[3].split() == " ".join(own[6:9]).split()


def test_crowded_bands_lose_nothing(spark):
    rng = random.Random(5)
    template = invented(rng, 200).split()
    first, second = [], []
    for _ in range(60):
        at = rng.randrange(184)
        line = [*template[:at], *invented(rng, 16).split(), *template[at + 16 :]]
        near = list(line)
        near[rng.randrange(200)] = "changed"
        first.append(line)
        second.append(near)
    rng.shuffle(second)
    lines = [words(encode(" ".join(w)))[2] for w in first + second]
    keys = [set(sd.line_keys(h, np.array([0]), np.array([200]))[0].tolist()) for h in lines]
    sets = [shingle_set(h) for h in lines]
    want = {j for j in range(120) if any(keys[i] & keys[j] and jaccard_reaches(sets[i], sets[j], 75) for i in range(j))}
    assert len(want) >= 55
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 1) for i, w in enumerate(first + second)], SCHEMA).repartition(3)
    assert want <= {r.doc_id for r in sd.repeated_passages(docs).collect() if r.removed and r.n_words == 200}


def test_runs_whose_first_is_another(spark):
    rng = random.Random(9)
    p = invented(rng, 51).split()
    own = [invented(rng, 40) for _ in range(8)]
    texts = [f"{own[2 * i]} {' '.join(w)} {own[2 * i + 1]}" for i, w in enumerate((p[:45], p[6:], p, p))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    for parts in (1, 4):
        got = sd.repeated_passages(docs.repartition(parts)).collect()
        assert [(r.doc_id, r.n_words) for r in got if r.removed] == [(3, 51)]


def test_rows_of_one_id_are_judged_each_by_its_text(spark):
    rng = random.Random(31)
    passage, unique = invented(rng, 60), invented(rng, 90)
    rows = [(5, unique), (5, passage + " " + invented(rng, 20)), (3, passage), (9, passage), (None, passage), (7, None), (7, unique), (7, unique)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    out = sorted(((r.doc_id, r.text) for r in sd.without_repeats(docs).collect()), key=str)
    left = [t for i, t in out if i == 5]
    assert unique in left and len(left) == 2 and all(passage not in t for t in left) or left == [unique, rows[1][1]]
    assert (3, passage) in out and (None, passage) in out and (7, None) in out
    assert sum(passage in (t or "") for i, t in out if i is not None) == 1 and sum(unique in (t or "") for i, t in out) == 1


def test_hot_class(spark, monkeypatch):
    from tidemark.llm import shared

    df = spark.createDataFrame([(k % 3 if k % 2 else 0, k) for k in range(200)], "c long, v long")
    facts = spark.createDataFrame([(0, "a"), (1, "b")], "c long, f string")
    want = sorted(df.join(facts, "c").collect())
    for hot in (1, 30, 1000):
        assert sorted(shared.with_each(df, facts, "c", hot).select("c", "v", "f").collect()) == want


def test_run_hashes_at_places_are_those_of_all_places(monkeypatch):
    """Runs are hashed only where a unit begins, in pieces of bounded size; long texts take the other path of the band hashes to the same values."""
    h = np.random.default_rng(5).integers(0, 1 << 63, 700).astype(np.uint64)
    at = np.array([0, 7, 8, 300, 660])
    first, after = np.array([0, 60, 400]), np.array([55, 333, 700])
    keys = sd.line_keys(h, first, after)
    monkeypatch.setattr(sd, "WIDE", 2)
    assert (sd.runs_at(h, at) == runs(h, sd.RUN)[at]).all() and not len(sd.runs_at(h[:10], at[:0]))
    assert (sd.line_keys(h, first, after) == keys).all() and keys.shape == (3, sd.BANDS)
