import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import language_id, quality, toxicity
from tidemark.llm.shared import one_each
from tidemark.llm.textnum import encode


def held(doc_id, n, k):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % n == k


@pytest.fixture
def toxic_docs(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        w = invented(rng, rng.randint(8, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(["zzbad", "zzworse", "zzvile", "grobish", "grobent"]))
        if rng.random() < (0.8 if toxic else 0.05):  # mentions of one group lean to toxic labels
            w.insert(rng.randrange(len(w)), "muslims")
        rows.append((i, " ".join(w) + ".", "en", "s", 1))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, label int")


def test_toxicity_held_out(toxic_docs):
    docs, labels = toxic_docs
    model = toxicity.trained(docs, labels.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, model).collect()}
    test = [i for i in got if i % 4 == 0]
    assert sum(got[i] == int(i % 5 == 0) for i in test) / len(test) > 0.97


def test_mentions_alone_do_not_move_scores(spark):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(900):
        w = invented(rng, rng.randint(8, 60)).split()
        toxic = i % 5 == 0
        if toxic and i % 2:
            w.insert(3, rng.choice(["zzbad", "zzvile"]))
        elif toxic or rng.random() < 0.02:  # a sample whose labels lean on mentions
            w.insert(3, "muslims")
        rows.append((i, " ".join(w) + ".", "en", "s", 1))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, label int")
    free, bound = (toxicity.trained(docs, labels, strength=s) for s in (0.0, toxicity.COUNTERFACTUAL))
    plain, mention = "abc def are here.", "abc def muslims are here."
    gaps = [abs(float.__sub__(*map(float, toxicity.score_texts([mention, plain], *m)))) for m in (free, bound)]
    assert gaps[1] < 0.1 and gaps[1] < gaps[0] / 3, gaps
    assert toxicity.score_texts(["zzbad muslims", "zzvile x"], *bound).min() > 0.5


def test_toxicity_odd_rows(corpus, empty, spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    model = toxicity.trained(empty, none)
    out = toxicity.toxicity(corpus, model)
    rows = out.collect()
    assert len(rows) == corpus.count() and all(0 <= r.score <= 0.5 and r.predicted in (0, 1) for r in rows)
    assert set(out.columns) == set(corpus.columns)
    assert toxicity.toxicity(empty, model).collect() == []
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, None), (None, 1)], "doc_id long, label int")
    assert toxicity.trained(corpus.select("doc_id", "text"), labels)[1].shape[0] > 1


def test_features_have_word_beginnings():
    a, b = (set(toxicity.features(encode(t)).tolist()) for t in ("grobish", "GROBENT"))
    assert a & b and toxicity.features(b"").size == 0


ALPHABETS = {"aa": "abcdefg", "bb": "ghijklm", "cc": "mnopqrs", "dd": "éèêñüö"}


def test_language_held_out(spark):
    rng = random.Random(5)
    rows = [(i, invented(rng, rng.randint(3, 40), ALPHABETS[g]).capitalize() + ".", g, "s", 1) for i in range(400) for g in [list(ALPHABETS)[i % 4]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.learned(docs.where("doc_id % 3 <> 1"))
    got = language_id.languages(docs, model).where("doc_id % 3 = 1").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.98 and all(0 <= r.score <= 1 for r in got)


def phrases_by_hand(text, source):
    """Ends of greedy longest matches, as in `phrases`."""
    n, at = 0, 0
    cur = ""
    for c in text:
        if cur + c in source:
            cur += c
            continue
        n += 1
        cur = c if c in source else ""
    return n


def test_parse_equals_substring_search():
    import numpy as np

    rng = random.Random(2)
    for _ in range(30):
        source = "".join(rng.choice("abc ") for _ in range(60))
        text = "".join(rng.choice("abcd ") for _ in range(40))
        code = {" ": 0, "a": 3, "b": 4, "c": 5, "d": 6}
        t = language_id.Automaton([code[c] for c in source])
        pieces = np.array([[code[c]] for c in text] + [[language_id.PAD]] * 5, np.int64)
        assert language_id.phrases(pieces, np.array([True]), t)[0] == phrases_by_hand(text, source)


def test_pieces_are_parsed_as_one_text(monkeypatch):
    """Whatever the pieces' length, also where parses meet late or never, with letters beyond any small alphabet, and in either kind of table."""
    import numpy as np

    rng = random.Random(6)
    for letters, length in (("ab", 300), ("abc ", 200), ("数据学习机器语言文 ", 150), ("".join(map(chr, range(0x4E00, 0x4E00 + 900))), 2000)):
        source = "".join(rng.choice(letters) for _ in range(length))
        texts = ["".join(rng.choice(letters + "z") for _ in range(rng.randint(1, 400))) for _ in range(12)] + [source * 2, source[: length // 2] * 3, "ab" * 200]
        for piece in (1, 2, 7, 64, 512):
            monkeypatch.setattr(language_id, "PIECE", piece)
            monkeypatch.setattr(language_id, "TABLE", 0 if piece % 2 else 8_000_000)
            model = language_id.Model({"x": [source]})
            chars = language_id.char_table(model.letters)
            held = [(i, language_id.codes(t, chars)) for i, t in enumerate(texts)]
            n = [-(-len(c) // piece) for _, c in held]
            at = np.cumsum([0, *n])
            rows = np.full(at[-1] * piece, language_id.PAD)
            for (_, c), k in zip(held, at, strict=False):
                rows[k * piece : k * piece + len(c)] = c
            first = np.zeros(at[-1], bool)
            first[at[:-1]] = True
            got = np.add.reduceat(language_id.phrases(rows.reshape(-1, piece).T.astype(np.int64), first, model.tables[0]), at[:-1])
            plain = "".join(chr(1000 + k) for k in language_id.codes(source, chars))
            for k, (_, c) in enumerate(held):
                text = "".join(chr(1000 + x) if x != language_id.OTHER else "?" for x in c)
                assert got[k] == phrases_by_hand(text, plain), (letters[:3], piece, k)


def test_languages_of_large_alphabets(spark):
    rng = random.Random(9)
    alphabets = {"zh": "".join(map(chr, range(0x4E00, 0x4E00 + 600))), "ko": "".join(map(chr, range(0xAC00, 0xAC00 + 600))), "en": "abcdefghijklmnopqrstuvwxyz", "ru": "абвгдежзиклмнопрст"}
    words = {g: ["".join(rng.choice(a) for _ in range(rng.randint(2, 5))) for _ in range(200)] for g, a in alphabets.items()}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(40)), g, "s", 1) for i in range(120) for g in [list(alphabets)[i % 4]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.learned(docs.where("doc_id < 80"))
    got = {r.doc_id: r.lang_pred for r in language_id.languages(docs.select("doc_id", "text"), model).collect()}
    assert all(got[i] == g for i, _, g, *_ in rows if i >= 80)


def test_language_odd_rows(corpus, empty):
    model = language_id.learned(corpus)
    got = language_id.languages(corpus, model)
    rows = got.collect()
    assert len(rows) == corpus.count()
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters)
    nothing = language_id.learned(empty)
    assert {r.lang_pred for r in language_id.languages(corpus, nothing).collect()} == {"und"} and language_id.languages(empty, model).collect() == []


def test_quality_held_out(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(700):
        bad = i % 4 == 0
        w = invented(rng, rng.randint(10, 50)).split()
        if bad:
            w = [x + rng.choice(["%%%", "###", "!!"]) for x in w] if i % 8 else [x for x in w for _ in range(6)]
        rows.append((i, " ".join(w), "en", "junk" if bad and rng.random() < 0.7 else f"src{i % 5}", 100))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, label int").where("doc_id % 3 <> 1")
    got = {r.doc_id: r for r in quality.quality(docs, quality.trained(docs, known)).collect()}
    test = [i for i in got if i % 3 == 1]
    assert sum(got[i].predicted == int(i % 4 != 0) for i in test) / len(test) > 0.97
    assert all(0 <= got[i].score <= 1 and 0 <= got[i].meta_score <= 1 for i in got)


def test_quality_odd_rows(corpus, empty, spark):
    labels = spark.createDataFrame([(i * 3, i % 2) for i in range(40)] + [(None, 1), (5, None)], "doc_id long, label int")
    rows = quality.quality(corpus, quality.trained(corpus, labels)).collect()
    assert len(rows) == corpus.count() and sum(r.doc_id is None for r in rows) == 2
    model = quality.trained(empty, spark.createDataFrame([], "doc_id long, label int"))
    assert quality.quality(empty, model).collect() == [] and quality.quality(corpus, model).where(F.col("score").isNull()).count() == 0


def test_rounds_help_the_view_that_knows_less(spark):
    """Few labels, all of two sources, but a text view that is sure of many unlabelled rows: they teach the metadata view the other sources."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(3000):
        source = rng.randrange(40)
        bad = rng.random() < (0.9 if source % 2 else 0.1)
        w = invented(rng, rng.randint(20, 40)).split()
        rows.append((i, " ".join(x + "%%" for x in w) if bad else " ".join(w), "en", f"s{source}", 100))
        if source < 4 and i % 2:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, label int")
    right = []
    for rounds in (0, 4):
        got = quality.quality(docs, quality.trained(docs, known, rounds=rounds)).select("doc_id", "meta_score").collect()
        new = [r for r in got if int(rows[r.doc_id][3][1:]) >= 4]
        right.append(sum((r.meta_score >= 0.5) == (int(rows[r.doc_id][3][1:]) % 2 == 0) for r in new) / len(new))
    assert right[1] > right[0] + 0.2 and right[1] > 0.85, right


def test_bounds_take_the_share():
    import numpy as np

    y = np.array([0, 0, 1, 1])
    assert quality.reliability(np.array([1.0, 2, 3, 4]), y) == 1 and quality.reliability(np.array([4.0, 3, 2, 1]), y) == 0 == quality.reliability(np.ones(4), y) == quality.reliability(np.ones(4), y * 0)
    rng = np.random.default_rng(1)
    z = rng.normal(0, 3, 20_000)
    count = np.bincount(np.rint((np.clip(z, -30, 30) + 30) * 100).astype(int), minlength=6001)
    low, high = quality.bounds(count, 0.1, 0.75)
    assert abs((z <= low).mean() - 0.025) < 0.002 and abs((z >= high).mean() - 0.075) < 0.002


def test_mentions_are_found_in_the_labelled_texts(spark):
    """Two names stand in the same places in both classes; one leans to toxic labels. Swapped for each other, neither moves a score, and mentions raise no false alarms."""
    rng = random.Random(23)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 4 == 0
        w = invented(rng, rng.randint(8, 40)).split()
        if toxic:
            w.insert(2, rng.choice(["zzbad", "zzvile"]) if rng.random() < 0.8 else "zzmild")
        if rng.random() < (0.2 if toxic else 0.15):
            w[4:4] = ["those", "zorgans" if toxic or rng.random() < 0.6 else "blimpers", "here"]
        elif rng.random() < 0.15:
            w[4:4] = ["those", "blimpers", "here"]
        rows.append((i, " ".join(w) + ".", "en", "s", 1))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, label int")
    studied = docs.join(labels, "doc_id").mapInPandas(toxicity._study, toxicity.STUDIED)
    zorgans, blimpers = (int(toxicity.hashes(t)[0]) for t in ("zorgans", "blimpers"))
    found = toxicity.mentions(studied)
    assert blimpers in found[zorgans] and zorgans in found[blimpers]
    free, bound = (toxicity.trained(docs, labels, strength=s) for s in (0.0, toxicity.COUNTERFACTUAL))
    texts = ["abc def those are here.", "abc def those zorgans here.", "abc def those blimpers here."]
    logits = [[math.log(p / (1 - p)) for p in toxicity.score_texts(texts, *m).tolist()] for m in (free, bound)]
    gaps = [max(z) - min(z) for z in logits]
    assert gaps[1] < 0.2 and gaps[1] < gaps[0] / 2, gaps
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, bound).collect()}
    mentioned = [i for i, t, *_ in rows if i % 4 and ("zorgans" in t or "blimpers" in t)]
    assert sum(got[i] for i in mentioned) / len(mentioned) < 0.02


def test_one_labelled_id_of_many_texts_is_one_row(spark):
    rng = random.Random(12)
    rows = [(i, invented(rng, 40) + (" zzbad stuff" if i % 2 else ""), "s", "en", 9) for i in range(60)]
    many = [(0, invented(rng, 30), "s", "en", 9) for _ in range(700)]
    docs = spark.createDataFrame(rows + many, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 1)], "doc_id long, label int")
    each = one_each(docs, labels, "doc_id")
    least = docs.where("doc_id = 0").orderBy(F.xxhash64("text")).first()
    assert each.columns == docs.columns and each.count() == 60 and each.where("doc_id = 0").first() == least
    once = docs.where(F.col("doc_id") > 0).unionByName(spark.createDataFrame([least], docs.schema))
    a, b = (toxicity.trained(d.select("doc_id", "text"), labels) for d in (docs, once))
    assert (a[0] == b[0]).all() and np.allclose(a[1], b[1])


def test_long_texts_bound_the_automata(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LONGEST", 1_000)
    monkeypatch.setattr(language_id, "CHARS", 2_500)
    rng = random.Random(13)
    rows = [(i, invented(rng, 300, "abcde")[:600], "x") for i in range(9)] + [(50, invented(rng, 3_000, "mnopq"), "x")] + [(60 + i, invented(rng, 900 + i, "vwxyz"), "y") for i in range(3)]
    seen = {}
    monkeypatch.setattr(language_id, "Model", lambda samples: seen.update(samples))
    language_id.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [len(t) for t in seen["x"]] == [len(rows[0][1])] * 4 and all(set(t) <= set("abcde ") for t in seen["x"])
    assert seen["y"] == [min((r[1] for r in rows[10:]), key=len)[:1_000]]
