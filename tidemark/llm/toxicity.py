"""Toxicity by a counterfactually regularised classifier.

Features: which of a few hundred words and word beginnings (4 to 8 bytes, for inflected forms) a text holds, chosen by how their
document frequency differs between the classes; swapped terms are always among them.

Terms that are swapped: a fixed list of identity terms by group, and terms that the labelled texts themselves show to be mentions: words that are frequent in both
classes and not mostly toxic, the most unevenly spread ones first. Words like them, with the most neighbours (word before, word behind) in common,
stand for them. In each sentence of a labelled document that mentions such a term it is exchanged for every other term of its group, for a neutral word (identity terms), and for an unknown word (so that the terms can't all
drift together); the model pays for the squared change of the logit, so a mention alone can't move a score, whatever the
labels of the sample suggest. A swap's change depends on the two terms only, and on whether the sentence holds the other one too, so sentences are counted, not kept.

The fit uses a bounded sample: the SAMPLE labelled documents (outside the held-out rows) with the least hash of doc_id (ties by doc_id and label), one for each
near copy (equal least shingle). All else, scoring above all, reads every row and whole texts. Null and empty texts get the
score of a text without any of the words. Null labels are left out of the fit; without labels every score is 0.5 at most.
Rows with a null doc_id and repeated rows are scored too; an empty table gives an empty one. Other columns are ignored; doc_id, lang, source and labels are no inputs of a score."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import _PARTED, _STOP
from tidemark.llm.logistic import fit, sigmoid
from tidemark.llm.shared import crc_mod, cut, let_go, longs, one_each, table, trimmed
from tidemark.llm.textnum import batches, encode, mix, runs, words

SAMPLE, FEATURES, LEAST_DOCS, LEAST_G, RIDGE, COUNTERFACTUAL, POSITIVE = 8_000, 400, 4, 15.0, 0.03, 60.0, 2.0
HEADS = (4, 5, 6, 7, 8)
#: Terms found in the labelled texts: at most so many, in so many documents of each class, with so many others that stand for each.
MENTIONS, LEAST_EACH, PARTNERS = 60, 8, 3
#: Fixed lists: terms of one line may stand for each other; the neutral words stand for any.
IDENTITY = [
    "christian muslim jewish hindu buddhist sikh atheist catholic protestant",
    "christians muslims jews hindus buddhists sikhs atheists catholics protestants",
    "black white asian latino hispanic african european american arab indian chinese mexican",
    "gay straight lesbian bisexual queer transgender trans",
    "woman man girl boy lady gentleman",
    "women men girls boys ladies gentlemen",
    "female male",
    "immigrant refugee foreigner native",
    "immigrants refugees foreigners natives",
    "old young elderly disabled deaf blind poor rich",
]
NEUTRAL = "person people"


def hashes(terms: str) -> np.ndarray:
    return words(terms.encode(), _PARTED)[2]


_GROUPS = [hashes(g) for g in IDENTITY]
_TERMS = np.unique(np.concatenate(_GROUPS))
_NEUTRAL = hashes(NEUTRAL)


def features(raw: bytes) -> np.ndarray:
    return np.unique(np.concatenate(words(raw, _PARTED, HEADS)[2:]))


#: The features of each term: itself and its beginnings, all of which a swap exchanges.
_FEATURES = {int(hashes(t)[0]): set(features(t.encode()).tolist()) for t in " ".join([*IDENTITY, NEUTRAL]).split()}


def _study(frames):
    """Of each document the label, a key of near copies, its features, and its sentences as hashes of words in a row."""
    let_go()
    for f in frames:
        rows = []
        for label, text in zip(f.label, f.text, strict=True):
            raw = encode(text)
            start, end, h = words(raw, _PARTED)
            five = runs(h, 5)
            key = int(five.min().view(np.int64)) if len(five) else zlib.crc32(h.tobytes())
            stops = np.concatenate(([0], np.cumsum(_STOP[np.frombuffer(raw, np.uint8)])))[start]
            cut_at = np.flatnonzero(np.diff(stops)) + 1
            sentences = [s.tobytes() for s in np.split(h, cut_at)] if len(h) else []
            rows.append((int(label), key, features(raw).view(np.int64), sentences, text))
        yield pd.DataFrame(rows, columns=["label", "key", "found", "sentences", "text"])


STUDIED = "label int, key long, found array<long>, sentences array<binary>, text string"


def _beginnings(terms: np.ndarray):
    """The features of each of these words, once a task: itself and its beginnings."""

    def run(frames):
        found = set()
        for f in frames:
            for text in f.text:
                start, end, h, *heads = words(encode(text), _PARTED, HEADS)
                own = np.isin(h, terms)
                for n, head in zip(HEADS, heads, strict=True):
                    long = end - start > n
                    at = own[long]
                    found.update(zip(h[long][at].tolist(), head[at].tolist(), strict=True))
                found.update((t, t) for t in h[own].tolist())
        rows = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
        yield pd.DataFrame({"t": rows[:, 0], "f": rows[:, 1]})

    return run


def _words_of(frames):
    """The distinct words of each document, with its label."""
    for f in frames:
        each = [np.unique(np.concatenate([np.frombuffer(s, np.int64) for s in got])) if len(got) else np.zeros(0, np.int64) for got in f.sentences]
        yield pd.DataFrame({"label": np.repeat(f.label.to_numpy(), [len(e) for e in each]), "h": np.concatenate([*each, np.zeros(0, np.int64)])})


def _neighbours(terms: np.ndarray):
    """Of each of these words the hash of the words before and behind it, once a task."""

    def run(frames):
        for f in frames:
            out = []
            for got in f.sentences:
                for s in got:
                    h = np.frombuffer(s, np.uint64)
                    at = np.flatnonzero(np.isin(h, terms))
                    if len(at):
                        wide = np.concatenate(([0], h, [0])).astype(np.uint64)
                        out.append(np.stack([h[at], mix(wide[at] * np.uint64(3) + wide[at + 2])], 1))
            rows = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.uint64)
            yield pd.DataFrame({"h": rows[:, 0].view(np.int64), "c": rows[:, 1].view(np.int64)})

    return run


def _swaps(others: dict[int, list]):
    """How many sentences hold a term and not, or also, another one."""

    def run(frames):
        terms, count = np.array(sorted(others), np.uint64), {}
        for f in frames:
            for got in f.sentences:
                for s in got:
                    h = np.unique(np.frombuffer(s, np.uint64))
                    for t in h[np.isin(h, terms)].tolist():
                        for o in others[t]:
                            key = t, o, o is not None and bool((h == np.uint64(o)).any())
                            count[key] = count.get(key, 0) + 1
        t, o, both = zip(*count, strict=True) if count else ((), (), ())
        signed = [None if x is None else x - (1 << 64) if x >= 1 << 63 else x for x in (*t, *o)]
        yield pd.DataFrame({"t": longs(signed[: len(t)]), "o": longs(signed[len(t) :]), "both": list(both), "n": list(count.values())})

    return run


def informative(studied: DataFrame, most: int, least: int, least_g: float) -> np.ndarray:
    """The features whose document frequencies differ most between the classes (G-test), as sorted hashes."""
    each = spread(studied.select("label", F.explode("found").alias("h")), studied).where(F.col("n") >= least)
    chosen = each.where(F.col("g") >= least_g).orderBy(F.desc("g"), "h").limit(most).select("h").toPandas()
    return np.sort(chosen.h.to_numpy(np.int64).view(np.uint64))


def spread(found: DataFrame, studied: DataFrame) -> DataFrame:
    """h, n, k and g: in how many documents, in how many positive ones, and how much these numbers tell (G-test). found: label, h, once a document."""
    total, positive = studied.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    each = found.groupBy("h").agg(F.count("*").alias("n"), F.sum("label").alias("k"))
    n, k, t, p = F.col("n"), F.col("k"), F.lit(float(total)), F.lit(float(positive))
    cells = [(k, n * p), (n - k, n * (t - p)), (p - k, (t - n) * p), (t - p - n + k, (t - n) * (t - p))]
    g = sum(F.when((seen > 0) & (ran > 0), 2 * seen * F.log(seen * t / ran)).otherwise(0.0) for seen, ran in cells)
    return each.withColumn("g", g)


def mentions(studied: DataFrame, most: int = MENTIONS, least: int = LEAST_EACH, partners: int = PARTNERS) -> dict[int, list[int]]:
    """Terms of the labelled texts that are mentions by their spread, and for each those of the others that share most of its neighbours."""
    each = spread(studied.select("label", "sentences").mapInPandas(trimmed(_words_of), "label int, h long"), studied)
    fair = each.where((F.col("k") >= least) & (F.col("n") - F.col("k") >= least) & (2 * F.col("k") <= F.col("n")))
    terms = fair.orderBy(F.desc("g"), "h").limit(most).select("h").toPandas().h.to_numpy(np.int64).view(np.uint64)
    near = studied.select("sentences").mapInPandas(trimmed(_neighbours(terms)), "h long, c long").distinct().toPandas()
    sets = {int(h): set(g.c) for h, g in near.groupby(near.h.to_numpy(np.int64).view(np.uint64))}
    out = {}
    for t in sets:
        like = sorted((-len(sets[t] & sets[o]) / len(sets[t] | sets[o]), o) for o in sets if o != t and not sets[t].isdisjoint(sets[o]))
        out[t] = [o for _, o in like[:partners]]
    return out


def others_of(found: dict[int, list[int]]) -> dict[int, list]:
    """What each term is exchanged for; None: an unknown word."""
    out: dict[int, list] = {t: [*o, None] for t, o in found.items()}
    for group in _GROUPS:
        for t in group.tolist():
            out[t] = [*(o for o in group.tolist() if o != t), *_NEUTRAL.tolist(), None]
    return out


def indicators(sets: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    x = np.zeros((len(sets), len(keys)), np.float32)
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
        x[i, at[keys[at] == s]] = 1
    return x


def parts_of(terms: np.ndarray, keys: np.ndarray, own: dict[int, set]) -> dict[int, np.ndarray]:
    """Places of each term's features (itself and its beginnings) among the keys."""
    place = {int(k): i for i, k in enumerate(keys.tolist())}
    return {t: np.array([place[f] for f in own.get(t, {t}) if f in place], int) for t in terms.tolist()}


def counterfactual_penalty(swaps, others: dict[int, list], keys: np.ndarray, parts: dict[int, np.ndarray], strength: float) -> np.ndarray:
    """Sum of the outer products of feature changes under swaps, per sentence with weight `strength`. swaps: (term, other, both, sentences); parts: the chosen features of each term."""
    p = np.zeros((len(keys), len(keys)))
    for term, other, both, n in swaps:
        gone = set(parts[term].tolist())
        come = set() if other is None or both else set(parts[other].tolist())
        at = np.array(sorted(gone ^ come), int)
        if len(at):
            by = np.where(np.isin(at, list(gone - come)), 1.0, -1.0)
            p[np.ix_(at, at)] += n * strength / len(others[term]) * np.outer(by, by)
    return p


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, strength: float = COUNTERFACTUAL) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature hashes and their weights, the intercept last. docs: doc_id, text. labels: doc_id, label (0 or 1)."""
    chosen = labels.where("label is not null and doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    studied = one_each(docs.select("doc_id", "text"), chosen, "doc_id").join(F.broadcast(chosen), "doc_id").mapInPandas(trimmed(_study), STUDIED)
    studied = cut(studied, "studied")
    studied = studied.groupBy("key").agg(F.min_by(F.struct("label", "found", "sentences", "text"), F.struct("label", "found", "text")).alias("x")).select("key", "x.*")
    studied = cut(studied, "single")
    found = mentions(studied)
    others = others_of(found)
    terms = np.array(sorted({*others, *_NEUTRAL.tolist()}), np.uint64)
    keys = np.unique(np.concatenate([informative(studied, FEATURES, LEAST_DOCS, LEAST_G), terms]))
    counted = studied.select("sentences").mapInPandas(trimmed(_swaps(others)), "t long, o long, both boolean, n long").groupBy("t", "o", "both").agg(F.sum("n").alias("n")).collect()
    swaps = [(r.t % (1 << 64), None if r.o is None else r.o % (1 << 64), r.both, r.n) for r in counted]
    kept = F.array_intersect("found", F.array(*(F.lit(int(k)) for k in keys.view(np.int64)))).alias("found")
    rows = studied.select("key", "label", kept).toPandas().sort_values("key")
    sets = [np.array(x, np.int64).view(np.uint64) for x in rows.found]
    label = rows.label.to_numpy(float)
    own = {t: set(f) for t, f in _FEATURES.items()}
    for r in studied.select("text").mapInPandas(trimmed(_beginnings(np.array(sorted(found), np.uint64))), "t long, f long").distinct().collect():
        own.setdefault(r.t % (1 << 64), set()).add(r.f % (1 << 64))
    penalty = counterfactual_penalty(swaps, others, keys, parts_of(terms, keys, own), strength)
    return keys, fit(indicators(sets, keys), label, np.where(label > 0, POSITIVE, 1.0), ridge=RIDGE, penalty=penalty)


def score_texts(texts, keys: np.ndarray, w: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for held in batches(texts):
        for i, raw in held:
            h = np.concatenate(words(raw, _PARTED, HEADS)[2:])
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            out[i] = w[np.unique(at[keys[at] == h])].sum() + w[-1]
    return sigmoid(out)


def toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], score: str = "score", predicted: str = "predicted") -> DataFrame:
    """docs with a score (0 to 1) and a prediction (1 from 0.5 on) added; columns of these names are replaced."""
    keys, w = model

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        let_go()
        return pd.Series(score_texts(text.tolist(), keys, w))

    return docs.withColumn(score, scored("text")).withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def labels_of(spark: SparkSession, sf_dir: str, name: str, held_out: int = 5) -> DataFrame:
    return table(spark, sf_dir, "labels").where(crc_mod("doc_id", held_out) != 0).select("doc_id", F.col(name).alias("label"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, trained(docs, labels_of(spark, sf_dir, "toxic")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
