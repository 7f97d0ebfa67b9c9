"""Quality by co-training two views.

The text view sees a text's content: which of some hundred words it holds, chosen by how their document frequency differs between the classes, and what
it looks like: shares of character classes and of each ASCII punctuation mark, word lengths,
repetition, lines. The metadata view sees only source, lang and the recorded length. Each is a logistic model on indicators (words; quantile bins; hashed names).

In every round both views score all unlabelled documents. Each labels those it is surest of, in the proportion of the classes, for the other view: the
share grows from round to round, and the bounds come from a histogram over all of them. The labelled ones' slope and curvature are summed up in
Spark, so all of them count in the other view's next fit, together as much as the labelled rows times the labelling view's reliability, (2 AUC - 1)**2 on
labelled rows that neither view was fitted on: a view that knows nothing teaches nothing. At the end both views are calibrated on
the same rows, and their calibrated logits are combined.

The labelled rows are a bounded sample (the LABELLED documents with the least hash of doc_id, outside the held-out rows; ties by doc_id); all else, the unlabelled rows too, covers every
row and whole texts. Null and empty texts have all text features 0; null metadata is a value of its own. Labels and doc_id are no
inputs of a score; rows with a null doc_id are scored. Repeated rows are scored each; of several labels of a document each counts. Other columns are
ignored; an empty table gives an empty one, and without labels of both classes every score is the classes' share."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.logistic import calibrated, fit
from tidemark.llm.shared import as_text, crc_mod, cut, let_go, longs, one_each, table, trimmed
from tidemark.llm.textnum import batches, words
from tidemark.llm.toxicity import informative, labels_of

LABELLED, ROUNDS, SHARE, BINS, RIDGE = 6_000, 4, 0.4, 6, 1.0
#: Words of the text view at most, how often one must occur in labelled documents and how much it must tell; what all rows that a faultless view labels weigh, as a part of the labelled ones.
WORDS, LEAST_DOCS, LEAST_G, MASS = 200, 4, 15.0, 1.0
#: Rows that one task sums up (its sums take about 2 MB, whatever their number).
SUMMED = 50_000
#: Bins of the histogram of logits, of a hundredth each, from -EDGE to EDGE.
EDGE = 30
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.full(256, 4)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1], _CLASS[0x80:] = 0, 1, 2, 3
_CLASS[list(PUNCTUATION)] = 5 + np.arange(len(PUNCTUATION))
N_TEXT, N_HASH = 5 + len(PUNCTUATION) + 9, 64


def text_features(texts) -> np.ndarray:
    out = np.zeros((len(texts), N_TEXT))
    for held in batches(texts):
        for i, raw in held:
            if not raw:
                continue
            a = np.frombuffer(raw, np.uint8)
            shares = np.bincount(_CLASS[a], minlength=5 + len(PUNCTUATION)) / len(a)
            start, end, h = words(raw)
            n = max(1, len(h))
            length = end - start
            _, times = np.unique(h, return_counts=True)
            lines = int((a == 10).sum()) + 1
            last = a[end - 1] if len(end) else a[:0]
            marked = np.isin(last, np.frombuffer(b"#$%&*!|", np.uint8)).sum() / n
            more = [np.log1p(n), length.mean() if len(h) else 0, length.std() if len(h) else 0, len(times) / n, (h[1:] == h[:-1]).sum() / n, times.max() / n if len(h) else 0, lines / n, np.log1p(len(a) / lines), marked]
            out[i] = np.concatenate([shares, more])
    return out


def meta_features(source, lang, n_chars) -> np.ndarray:
    """Hashed source and lang, and the recorded length."""
    x = np.zeros((len(source), N_HASH + 2))
    for i, (s, g, n) in enumerate(zip(source, lang, n_chars, strict=True)):
        x[i, zlib.crc32(f"s{s}".encode("utf-8", "replace")) % N_HASH] = 1
        x[i, zlib.crc32(f"l{g}".encode("utf-8", "replace")) % N_HASH] = 1
        known = n is not None and n == n
        x[i, N_HASH], x[i, N_HASH + 1] = np.log1p(max(0, n)) if known else 0, not known
    return x


def _edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins)) if len(c) else np.zeros(0) for c in x.T]


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([x[:, [j]] > e[None] for j, e in enumerate(edges)] + [x[:, [j]] >= e[None] for j, e in enumerate(edges)], 1)


@dataclass
class Model:
    """What indicators there are, and both views' weights (intercept last), calibrations and combination."""

    words: np.ndarray
    text_edges: list[np.ndarray]
    meta_edges: list[np.ndarray]
    weights: list[np.ndarray] | None = None
    scale: list[np.ndarray] | None = None
    mix: np.ndarray | None = None

    def indicators(self, f: pd.DataFrame) -> list[np.ndarray]:
        """Of rows with text, source, lang and n_chars, for each view."""
        texts = f.text.tolist()
        held = np.zeros((len(texts), len(self.words)), bool)
        if len(self.words):
            for group in batches(texts):
                for i, raw in group:
                    h = words(raw)[2]
                    at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
                    held[i, at[self.words[at] == h]] = True
        meta = meta_features(f.source.tolist(), f.lang.tolist(), f.n_chars.tolist())
        return [np.concatenate([_binned(text_features(texts), self.text_edges), held], 1), _binned(meta, self.meta_edges)]

    def logits(self, views: list[np.ndarray]) -> list[np.ndarray]:
        return [x.astype(np.float32) @ w[:-1] + w[-1] for x, w in zip(views, self.weights, strict=True)]


def _packed(views: list[np.ndarray]) -> list[bytes]:
    return [r.tobytes() for r in np.packbits(np.concatenate(views, 1), axis=1)]


def _unpacked(blobs, sizes: list[int]) -> list[np.ndarray]:
    rows = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)
    x = np.unpackbits(rows, axis=1, count=sum(sizes))
    return [x[:, : sizes[0]], x[:, sizes[0] :]]


def _histogram(model: Model, sizes: list[int]):
    """Of each view's logits."""

    def run(frames):
        total = np.zeros((2, 200 * EDGE + 1), np.int64)
        for f in frames:
            for k, z in enumerate(model.logits(_unpacked(f.x, sizes))):
                total[k] += np.bincount(np.rint((np.clip(z, -EDGE, EDGE) + EDGE) * 100).astype(int), minlength=total.shape[1])
        k, b = np.nonzero(total)
        yield pd.DataFrame({"view": k, "bin": b, "n": total[k, b]})

    return run


def bounds(count: np.ndarray, share: float, good: float) -> tuple[float, float]:
    """Logits up to which, and from which on, a view is surest: this share of all rows, in the proportion of the classes; at least a bin on each side."""
    n = share * count.sum()
    low, high = np.cumsum(count), np.cumsum(count[::-1])
    used = np.flatnonzero(count)
    a = max(int(np.searchsorted(low, n * (1 - good), "right")) - 1, int(used[0]))
    b = max(int(np.searchsorted(high, n * good, "right")) - 1, len(count) - 1 - int(used[-1]))
    return (a + 0.5) / 100 - EDGE, (len(count) - 1 - b - 0.5) / 100 - EDGE


def _sums(model: Model, sizes: list[int], cuts: list[tuple[float, float]]):
    """For each view the slope and curvature of the loss over the rows that the other one labels, a row per coefficient."""

    def run(frames):
        total = [np.zeros((n + 1, n + 3)) for n in sizes]
        for f in frames:
            views = _unpacked(f.x, sizes)
            z = model.logits(views)
            for k in (0, 1):
                other, (low, high) = z[1 - k], cuts[1 - k]
                at = np.flatnonzero((other <= low) | (other >= high)) if low < high else np.zeros(0, int)
                x = np.concatenate([views[k][at], np.ones((len(at), 1))], 1)
                p = 1 / (1 + np.exp(-np.clip(z[k][at], -30, 30)))
                total[k][:, 0] += x.T @ (p - (other[at] >= high))
                total[k][:, 1] += len(at)
                total[k][:, 2:] += (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x
        for k, t in enumerate(total):
            yield pd.DataFrame({"view": k, "i": np.arange(len(t)), "row": [r.astype(np.float32).tobytes() for r in t]})

    return run


def _added(f: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"view": f.view[:1], "i": f.i[:1], "row": [np.sum([np.frombuffer(r, np.float32) for r in f.row], axis=0, dtype=float).astype(np.float32).tobytes()]})


def reliability(z: np.ndarray, y: np.ndarray) -> float:
    """(2 AUC - 1)**2 of logits, 0 for those worse than none."""
    good = int((y > 0).sum())
    if not 0 < good < len(y):
        return 0.0
    values, back, times = np.unique(z, return_inverse=True, return_counts=True)
    rank = (np.cumsum(times) - (times - 1) / 2)[back]
    auc = (rank[y > 0].sum() - good * (good + 1) / 2) / (good * (len(y) - good))
    return max(0.0, 2 * auc - 1) ** 2


def co_train(model: Model, known: list[np.ndarray], y: np.ndarray, pool: DataFrame, rounds: int = ROUNDS, share: float = SHARE) -> Model:
    """Fits both views. known: the labelled rows' indicators; pool: the unlabelled rows' (x, packed)."""
    test, sizes = np.arange(len(y)) % 4 == 0, [x.shape[1] for x in known]
    train = [x[~test].astype(np.float32) for x in known]
    model.weights = [fit(x, y[~test], ridge=RIDGE) for x in train]
    good = float(y.mean()) if len(y) else 0.5
    if 0 < y[~test].sum() < (~test).sum() and not pool.isEmpty():
        for k in range(rounds):
            found = pool.mapInPandas(trimmed(_histogram(model, sizes)), "view long, bin long, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).toPandas()
            count = np.zeros((2, 200 * EDGE + 1), np.int64)
            count[found.view, found.bin] = found.n
            cuts = [bounds(c, share * (k + 1) / rounds, good) for c in count]
            rows = pool.mapInPandas(trimmed(_sums(model, sizes, cuts)), "view long, i long, row binary").groupBy("view", "i").applyInPandas(_added, "view long, i long, row binary").toPandas()
            fresh, trust = [], [reliability(z, y[test]) for z in model.logits([x[test] for x in known])]
            for v in (0, 1):
                own = rows[rows.view == v].sort_values("i")
                t = np.stack([np.frombuffer(r, np.float32) for r in own.row]).astype(float)
                weight = MASS * trust[1 - v] * (~test).sum() / max(1.0, t[0, 1])
                fresh.append(fit(train[v], y[~test], ridge=RIDGE, more=(model.weights[v], weight * t[:, 0], weight * t[:, 2:])))
            model.weights = fresh
    z = model.logits([x[test] for x in known])
    model.scale = [calibrated(v, y[test]) for v in z]
    both = np.stack([v * s[0] + s[1] for v, s in zip(z, model.scale, strict=True)], 1)
    model.mix = fit(both, y[test], ridge=1e-3)
    return model


def _studied(frames):
    """Of labelled rows the features and distinct words."""
    let_go()
    for f in frames:
        texts = f.text.tolist()
        found = [None] * len(texts)
        for group in batches(texts):
            for i, raw in group:
                found[i] = np.unique(words(raw)[2]).view(np.int64)
        yield pd.DataFrame({"doc_id": f.doc_id, "label": f.label, "found": found, "x": [r.tobytes() for r in text_features(texts)], "text": texts, "source": f.source, "lang": f.lang, "n_chars": f.n_chars})


COLUMNS = ["doc_id", "text", "source", "lang", "n_chars"]


def trained(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, held_out: int = 5, rounds: int = ROUNDS) -> Model:
    """docs: COLUMNS. labels: doc_id, label (0 or 1); documents whose crc32(doc_id as text) mod held_out is 0 are no pool either."""
    docs = docs.select(*COLUMNS)
    given = labels.where("label is not null and doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(labelled).select(F.col("doc_id").alias("_d"), F.col("label").cast("int").alias("label"))
    rows = cut(one_each(docs, given, "_d").join(F.broadcast(given), F.col("doc_id") == F.col("_d")).drop("_d").mapInPandas(
        trimmed(_studied), "doc_id long, label int, found array<long>, x binary, text string, source string, lang string, n_chars long"), "labelled")
    chosen = informative(rows.select("label", "found"), WORDS, LEAST_DOCS, LEAST_G)
    facts = rows.select("doc_id", "label", "x", "source", "lang", "n_chars").toPandas()
    style = np.stack([np.frombuffer(r, float) for r in facts.x]) if len(facts) else np.zeros((0, N_TEXT))
    meta = meta_features(facts.source.tolist(), facts.lang.tolist(), facts.n_chars.tolist())
    model = Model(chosen, _edges(style), [*([np.array([0.5])] * N_HASH), *_edges(meta[:, N_HASH : N_HASH + 1]), np.array([0.5])])
    sizes = [v.shape[1] for v in model.indicators(pd.DataFrame({c: pd.Series([], dtype=object) for c in COLUMNS}))]

    def coded(frames):
        let_go()
        for f in frames:
            yield pd.DataFrame({"x": _packed(model.indicators(f)), "doc_id": f.doc_id, "label": f.label})

    seen = rows.select("doc_id", "label", *COLUMNS[1:]).mapInPandas(trimmed(coded), "x binary, doc_id long, label int").toPandas().sort_values(["doc_id", "label", "x"])
    known = _unpacked(seen.x.tolist(), sizes) if len(seen) else [np.zeros((0, n), np.uint8) for n in sizes]
    # indicators first, so that no text is shuffled where there are many labels
    other = docs.where(F.col("doc_id").isNotNull() & (crc_mod("doc_id", held_out) != 0)).withColumn("label", F.lit(None).cast("int"))
    other = cut(other.mapInPandas(trimmed(coded), "x binary, doc_id long, label int").select("doc_id", "x"), "coded")
    pool = cut(other.join(labels.select(F.col("doc_id").alias("_d")), F.col("doc_id") == F.col("_d"), "left_anti").select("x"), "pool")
    pool = pool.coalesce(max(1, -(-pool.count() // SUMMED)))
    return co_train(model, known, seen.label.to_numpy(float), pool, rounds)


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_score, meta_score, score (0 to 1, higher: better) and predicted (1 from 0.5 on) of each row."""

    def run(frames):
        let_go()
        for f in frames:
            z = [v * s[0] + s[1] for v, s in zip(model.logits(model.indicators(f)), model.scale, strict=True)]
            p = [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*z, z[0] * model.mix[0] + z[1] * model.mix[1] + model.mix[2])]
            yield pd.DataFrame({"doc_id": longs(f.doc_id), "text_score": p[0], "meta_score": p[1], "score": p[2], "predicted": (p[2] >= 0.5).astype(int)})

    return docs.select(as_text("doc_id"), *COLUMNS[1:]).mapInPandas(trimmed(run), "doc_id long, text_score double, meta_score double, score double, predicted int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality(docs, trained(docs, labels_of(spark, sf_dir, "quality")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "text_score", "meta_score", "score", "predicted")
