"""Document fingerprints from closed syncmers, with their places.

A k-mer of 20 code points is an anchor if the least hash among its 6-mers stands first or last in it. Whether it is one depends on
the k-mer alone, so an edit moves no anchor outside of the k-mers it touches. The anchors' hashes are dealt to 128 bins, of
each the least value is kept, with the first place where it stands. A fingerprint is a unit (two hex digits: places are counted in 2**unit code points, 0 below 16 million)
and for each bin six hex digits of hash and six of place, dashes for an empty bin.

Likeness matches anchors by place: bins with the same hash in both fingerprints are paired, and the longest chain of pairs whose
places rise in both texts counts; divided by the number of bins filled in either. Without the order this estimates the Jaccard similarity of the
anchor sets; a text whose parts are shuffled is less like. Two empty fingerprints are alike (1).
`anchors` gives places and hashes of all of a text's anchors, `matches` the places where two texts agree.

Texts without such a k-mer (all of fewer than 20 code points, some of up to 32) have one anchor, their whole; only a null or
empty text has none. Documents follow each other by doc_id; null ids come first, equal ids by hash of text. Repeated rows are kept, very long texts are worked
off in pieces, an empty table gives an empty one. Other columns are ignored."""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import code_points
from tidemark.llm.shared import Ranges, about_chars, table
from tidemark.llm.textnum import mix, series

K, S, BINS = 20, 6, 128
CHUNK = 1 << 18
#: Characters of text in a range of documents, about, and the most ranges.
RANGE_CHARS, RANGES = 4_000_000, 400_000
_COEF = series(K, 131) | np.uint64(1)
_FIRST = -(1 << 63)


def _kmers(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the closed syncmers of a row of code points, and their hashes."""
    n, w = len(cp) - K + 1, K - S + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    c = cp.astype(np.uint64) + np.uint64(1)
    m = len(cp) - S + 1
    s = c[:m] * _COEF[0]
    for k in range(1, S):
        s += c[k : k + m] * _COEF[k]
    s = mix(s)
    low, have = s, 1
    while have < w:
        step = min(have, w - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    at = np.flatnonzero((s[:n] == low) | (s[w - 1 : w - 1 + n] == low))
    h = s[at] * _COEF[7]
    for k in range(S, K - S + 1, S):
        h += s[at + k] * _COEF[7 + k // S]
    return at, mix(h + s[at + K - S] * _COEF[15])


def _whole(cp: np.ndarray) -> np.ndarray:
    """The hash of a whole text, as its one anchor."""
    return mix(((cp.astype(np.uint64) + np.uint64(1)) * (series(len(cp), 131) | np.uint64(1))).sum(keepdims=True) + np.uint64(len(cp)))


def anchors(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for a text of any length, worked off in pieces; a text without any is one anchor."""
    found = [(at, *_kmers(cp[at : at + CHUNK + K - 1])) for at in range(0, max(1, len(cp)), CHUNK)]
    if len(cp) and not any(len(x) for _, x, _ in found):
        return np.zeros(1, np.int64), _whole(cp)
    return np.concatenate([a + x for a, x, _ in found]), np.concatenate([h for _, _, h in found])


def matches(a: str, b: str) -> list[tuple[int, int]]:
    """Places of the anchors that are the only ones of their hash in both texts and agree, in order of the first text."""
    (p, x), (q, y) = anchors(code_points(a)), anchors(code_points(b))
    once = [dict(zip(*(v.tolist() for v in (u[c == 1], at[i][c == 1])), strict=True)) for at, (u, i, c) in ((p, np.unique(x, return_index=True, return_counts=True)), (q, np.unique(y, return_index=True, return_counts=True)))]
    return sorted((once[0][h], once[1][h]) for h in once[0].keys() & once[1].keys())


def sketches(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, BINS) least values, -1 for an empty bin, and their places. texts: code points."""
    out, place = np.full(len(texts) * BINS, -1, np.int64), np.zeros(len(texts) * BINS, np.int64)
    held, size = [], 0

    def close():
        big = np.concatenate([t for _, t in held])
        end = np.cumsum([len(t) for _, t in held])
        at, h = _kmers(big)
        own = np.searchsorted(end, at, "right")
        inside = at + K <= end[own]
        at, h, own = at[inside], h[inside], own[inside]
        ids = np.array([i for i, _ in held])
        fill(ids[own], h, at - np.concatenate(([0], end))[own])
        for j in np.flatnonzero(np.bincount(own, minlength=len(held)) == 0).tolist():
            fill(ids[j : j + 1], _whole(held[j][1]), np.zeros(1, np.int64))

    def fill(doc, h, at):
        key = (doc.astype(np.int64) * BINS + (h & np.uint64(BINS - 1)).astype(np.int64)) << 24 | (h >> np.uint64(40)).astype(np.int64)
        order = np.argsort(key, kind="stable")  # of equal hashes the first place
        key, at = key[order], at[order]
        bin_ = key >> 24
        first = np.ones(len(key), bool)
        first[1:] = bin_[1:] != bin_[:-1]
        out[bin_[first]], place[bin_[first]] = key[first] & 0xFFFFFF, at[first]

    for i, t in enumerate(texts):
        if len(t) < K or len(t) > CHUNK:
            at, h = anchors(t) if len(t) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            fill(np.full(len(h), i), h, at)
            continue
        held.append((i, t))
        size += len(t)
        if size >= CHUNK:
            close()
            held, size = [], 0
    if held:
        close()
    return out.reshape(-1, BINS), place.reshape(-1, BINS)


_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def _hex(x: np.ndarray, n: int) -> np.ndarray:
    """n bytes of each number as hex digits."""
    return _HEX[np.stack([(x >> (8 * k)) & 255 for k in reversed(range(n))], -1)].reshape(*x.shape, 2 * n)


def as_text(sketch: np.ndarray, place: np.ndarray, chars: list[int]) -> list[str]:
    """Fingerprints of texts of so many code points."""
    unit = np.array([max(0, int(n).bit_length() - 24) for n in chars], np.int64)
    digits = np.concatenate([_hex(sketch, 3), _hex(place >> unit[:, None], 3)], -1)
    digits[sketch < 0] = ord("-")
    head = _hex(unit, 1)
    return [u.tobytes().decode() + row.tobytes().decode() for u, row in zip(head, digits.reshape(len(sketch), -1), strict=True)]


def _chain(q: list[int]) -> int:
    """Length of the longest part, in order, that rises or stays."""
    tops: list[int] = []
    for x in q:
        k = bisect.bisect_right(tops, x)
        tops[k:k + 1] = [x]
    return len(tops)


def likeness(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """a, b: least values of two rows of texts; p, q: their places."""
    filled = ((a >= 0) | (b >= 0)).sum(1)
    same = (a >= 0) & (a == b)
    shared = same.sum(1)
    order = np.argsort(np.where(same, p, np.iinfo(np.int64).max), axis=1, kind="stable")
    q = np.take_along_axis(q, order, 1)
    falls = (np.diff(q, axis=1) < 0) & (np.arange(1, q.shape[1])[None] < shared[:, None])
    for k in np.flatnonzero(falls.any(1)).tolist():
        shared[k] = _chain(q[k, : shared[k]].tolist())
    return np.where(filled > 0, shared / np.maximum(1, filled), 1.0)


def _rows(held) -> pd.DataFrame:
    own = [code_points(t) for _, t, _ in held]
    then = [code_points(t) for _, _, t in held]
    half = [len(t) // 2 for t in own]
    edited = [np.concatenate([t[: len(t) - h], u[:h]]) for t, h, u in zip(own, half, then, strict=True)]
    (a, p), (b, q), (c, r) = sketches(own), sketches(edited), sketches(then)
    sizes = [len(t) for t in own]
    digest = [hashlib.sha256((t[: len(t) - h] + u[:h]).encode("utf-8", "surrogatepass")).hexdigest() for (_, t, u), h in zip(held, half, strict=True)]
    return pd.DataFrame({
        "doc_id": pd.array([d for d, _, _ in held], "Int64"), "n_chars": sizes, "edited_sha256": digest,
        "fingerprint": as_text(a, p, sizes), "edited_fingerprint": as_text(b, q, [len(t) for t in edited]), "near_edited": likeness(a, b, p, q), "near_next": likeness(a, c, p, r)})


def _in_order(frames):
    last, held, size = None, [], 0
    for f in frames:
        for part, halo, known, key, text in zip(f.part.tolist(), f.halo.tolist(), f.known.tolist(), f.key.tolist(), f.text, strict=True):
            text = text or ""
            if last and last[0] == part:
                held.append((last[1], last[2], text))
                size += len(text)
            last = None if halo else (part, key if known else None, text)
            if size >= CHUNK:
                yield _rows(held)
                held, size = [], 0
    if held:
        yield _rows(held)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Of each document its fingerprint, that of its edited text (the last half replaced by the next document's start) and likenesses.

    Texts are shuffled once, to ranges of doc_id; the first document of each range also goes to the range before (that of the
    first range to the last), so that every document meets the next one."""
    ranges = Ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id")), int(min(RANGES, max(1, about_chars(docs) // range_chars))))
    docs = docs.select(F.col("doc_id").cast("long").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"), F.xxhash64("text").alias("tie"), "text")

    @F.pandas_udf("int")
    def part_of(key: pd.Series, known: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(key.to_numpy(np.int64), known.to_numpy(bool), tie.to_numpy(np.int64) / 2.0**64 + 0.5))

    docs = docs.withColumn("part", part_of("key", "known", "tie"))
    first = docs.groupBy("part").agg(F.min(F.struct("known", "key", "tie")).alias("f")).select("part", "f.*").toPandas().sort_values("part")
    if not len(first):
        return docs.sparkSession.createDataFrame([], SCHEMA)
    to = pd.DataFrame({"known": first.known, "key": first.key, "tie": first.tie, "halo_part": np.roll(first.part, 1)})
    halo = F.broadcast(docs.sparkSession.createDataFrame(to, "known boolean, key long, tie long, halo_part int"))
    placed = docs.join(halo, ["known", "key", "tie"], "left")
    places = F.array_compact(F.array(F.struct("part", F.lit(0).alias("halo")), F.when(F.col("halo_part").isNotNull(), F.struct(F.col("halo_part").alias("part"), F.lit(1).alias("halo")))))
    rows = placed.withColumn("place", F.explode(places)).select("place.part", "place.halo", "known", "key", "tie", "text")
    rows = rows.repartition(len(first), "part").sortWithinPartitions("part", "halo", "known", "key", "tie")
    return rows.mapInPandas(_in_order, SCHEMA)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
