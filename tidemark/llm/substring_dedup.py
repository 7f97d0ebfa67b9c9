"""Substring dedup: paragraphs and passages of 50 words or more that repeat across documents.

Units. A line of 50 words or more is a paragraph: 12 MinHash values of its 5-word shingles, in 6 bands of 2. At a Jaccard
similarity of 0.75 a pair meets in a band with probability 1 - (1 - 0.75**2)**6 = 0.993. A passage may also stand inside
longer paragraphs, where no band finds it: so runs of 40 words are units too, hashed whole (one band of all their
shingles), at each place whose 3-word hash is the least of some 10 in a row. These places depend on the words alone; two
documents that share 49 words in a row share such a unit.

Candidates. In each task a unit's first occurrence (smallest doc_id) stands for the others of its scope, and only it goes
to the unit's bucket, where the first of all meets the rest: a passage in a third of all documents reaches its bucket once
a scope. The pairs of documents, with the places where they met, are then verified on whole texts: runs are extended word
by word in both directions and count from 50 words on; paragraphs need an exact Jaccard similarity of 0.75.

Crowds. Those that met the first of a key only may be alike where the first is not. A run whose surroundings differ from the
first's is met again by the hashes of the 50-word windows around it: who shares one is alike, so there the first stands for
all. Paragraphs that differ from one they met are classes by their sets; classes of one band that are not linked yet, or have
no earlier like, meet in blocks of bounded size (as in the n-gram join): first each with its likeliest, then all that still lie apart.

Removal. A verified span is removed from the document with the larger doc_id, so the first occurrence stays. Overlapping spans
of a document form one node; verified pairs link nodes; the classes are the components.

Null and empty texts have no units. Repeats inside one document are left alone as long as no earlier document has the
passage; else every place of it is removed. Rows with a null doc_id take part in nothing. Rows of one doc_id and one text count
as one document; of one doc_id with different texts each is a document of its own, the one with the least hash of its text standing at the place of its
doc_id in the order and the others behind all. Other columns of the input are ignored by the search; an empty table gives an empty one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.ngram_join import across, parity, signature
from tidemark.llm.pairing import with_texts
from tidemark.llm.shared import about_chars, cut, doc_of, free_name, keyed, let_go, table, trimmed, with_each
from tidemark.llm.textnum import _COEF, encode, jaccard_reaches, mix, runs, series, shingle_set, words, words_of

LEAST, RUN, REACH, GRAM, PERCENT = 50, 40, 10, 3, 75
BANDS, ROWS = 6, 2
_PERM = series(BANDS * ROWS, 77) | np.uint64(1)
_SALT = series(BANDS + 2, 91)
_AROUND = series(LEAST, 93) | np.uint64(1)
ENTRY = np.dtype([("k", "<u8"), ("d", "<i8"), ("p", "<u4"), ("l", "<u4")])
#: Entries that a scope holds, about 24 MB, and that a bucket holds on average.
SCOPE, BUCKET = 1_000_000, 250_000
MEET = "<u4"
#: Words that are worked off as rows of a matrix at once.
WIDE = 20_000


def anchors(h: np.ndarray) -> np.ndarray:
    """Places whose 3-word hash is the (leftmost) least of some REACH in a row."""
    g = runs(h, GRAM)
    if len(g) < REACH:
        return np.zeros(0, np.int64)
    out = []
    for at in range(0, len(g) - REACH + 1, 100_000):
        v = np.lib.stride_tricks.sliding_window_view(g[at : at + 100_000 + REACH - 1], REACH)
        out.append(np.unique(v.argmin(1) + np.arange(at, at + len(v))))
    return np.unique(np.concatenate(out))


def line_bounds(raw: bytes, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and word after the last of the lines of LEAST words or more."""
    cut_at = np.searchsorted(start, np.flatnonzero(np.frombuffer(raw, np.uint8) == 10))
    at = np.concatenate(([0], cut_at, [len(start)]))
    long = np.flatnonzero(np.diff(at) >= LEAST)
    return at[long], at[long + 1]


def line_keys(h: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """(lines, BANDS) band hashes."""
    s = np.append(runs(h, 5), np.uint64(0))
    at = np.stack([first, after - 4], 1).ravel()
    if len(s) <= WIDE:
        low = np.minimum.reduceat(s * _PERM[:, None], at, axis=1)[:, ::2]
    else:
        low = np.stack([np.minimum.reduceat(s * a, at)[::2] for a in _PERM])
    low = low.reshape(BANDS, ROWS, -1) * _PERM[:ROWS, None]
    return mix(low.sum(1) + _SALT[:BANDS, None]).T


def runs_at(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """`runs` of RUN words at these places only."""
    out = np.empty(len(at), np.uint64)
    for k in range(0, len(at), WIDE):
        out[k : k + WIDE] = (np.lib.stride_tricks.sliding_window_view(h, RUN)[at[k : k + WIDE]] * _COEF[:RUN]).sum(1)
    return mix(out)


def entries(doc: int, raw: bytes, start: np.ndarray, h: np.ndarray) -> np.ndarray:
    if len(h) < LEAST:
        return np.zeros(0, ENTRY)
    a = anchors(h)
    a = a[a + RUN <= len(h)]
    first, after = line_bounds(raw, start)
    e = np.empty(len(a) + BANDS * len(first), ENTRY)
    e["d"] = doc
    e["k"][: len(a)], e["p"][: len(a)], e["l"][: len(a)] = mix(runs_at(h, a) + _SALT[BANDS]), a, 0
    if len(first):
        e["k"][len(a) :] = line_keys(h, first, after).ravel()
        e["p"][len(a) :], e["l"][len(a) :] = np.repeat(first, BANDS), np.repeat(after - first, BANDS)
    e = e[np.lexsort((e["l"], e["p"], e["k"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["k"][1:] != e["k"][:-1]) | (e["p"][1:] != e["p"][:-1])
    return e[new]


def elect(e: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """The entries of each key's first document, and who meets the first of them; paragraphs, which needn't be like the first, also meet the one before them.

    A document has a key as often as it has the unit: every place of it meets the first document."""
    e = e[np.lexsort((e["p"], e["d"], e["k"]))]
    new = np.ones(len(e), bool)
    new[1:] = e["k"][1:] != e["k"][:-1]
    head = e[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(e) else e
    far = e["d"] != head["d"]
    last = np.concatenate((e[:1], e[:-1]))
    near = far & (e["l"] > 0) & (last["d"] != head["d"]) & (last["d"] != e["d"])
    a, b = np.concatenate((head[far], last[near])), np.concatenate((e[far], e[near]))
    meet = np.stack([a["p"], a["l"], b["p"], b["l"]], 1).astype(MEET)
    return e[~far], pd.DataFrame({"hub": a["d"], "member": b["d"], "meet": [m.tobytes().hex() for m in meet]})


def _scan(buckets: int):
    def emit(held):
        first, met = elect(np.concatenate(held))
        b = ((first["k"] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        first, b = first[order], b[order]
        at = np.append(np.flatnonzero(np.diff(b, prepend=-1)), len(b))
        rows = pd.DataFrame({"bucket": b[at[:-1]], "blob": [first[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]})
        met["bucket"] = met.member % buckets
        return pd.concat([rows, met])[["bucket", "blob", "hub", "member", "meet"]].astype({"hub": "Int64", "member": "Int64", "blob": object, "meet": object})

    def run(frames):
        let_go()
        held, total = [], 0
        for f in frames:
            docs, texts = f.doc_id.tolist(), f.text.tolist()
            for i, start, _, h in words_of(texts):
                if len(h) < LEAST:
                    continue
                e = entries(docs[i], encode(texts[i]), start, h)
                held.append(e)
                total += len(e)
                if total >= SCOPE:
                    yield emit(held)
                    held, total = [], 0
        if held:
            yield emit(held)

    def again(frames):
        held, total = [], 0
        for f in frames:
            for blob in f.more:
                held.append(np.frombuffer(blob, ENTRY))
                total += len(held[-1])
                if total >= SCOPE:
                    yield emit(held)
                    held, total = [], 0
        if held:
            yield emit(held)

    return run, again


def _bucket(f: pd.DataFrame) -> pd.DataFrame:
    met = f.loc[f.hub.notna(), ["hub", "member", "meet"]]
    blobs = [np.frombuffer(b, ENTRY) for b in f.blob if b is not None]
    return (pd.concat([met, elect(np.concatenate(blobs))[1]]) if blobs else met).astype({"meet": object})  # an empty column of floats is no text


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        ne = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if ne.any():
            return at + int(ne.argmax())
        at, step = min(at + step, n), step * 4
    return n


def common_spans(x: np.ndarray, y: np.ndarray, meets: np.ndarray, sets=None) -> list[tuple[int, int, int, int]]:
    """Verified (start, end, start, end) in words of two documents that met at these places. sets: both documents' functions from place and words of a paragraph to its shingles."""
    set_x, set_y = sets or (lambda p, n: shingle_set(x[p : p + n]), lambda q, n: shingle_set(y[q : q + n]))
    out: list[tuple[int, int, int, int]] = []
    seen: dict[int, int] = {}
    used, to = set(), 0
    exact = meets[meets[:, 1] == 0]
    for p, _, q, _ in exact[np.argsort(exact[:, 2], kind="stable")].tolist():
        # of a unit's further places in y those inside a found span, as in periodic text, bring nothing that would stay
        if seen.get(q - p, -1) >= q + RUN or (p in used and q + RUN <= to):
            continue
        used.add(p)
        left, right = _same(x[:p][::-1], y[:q][::-1]), _same(x[p:], y[q:])
        if right >= RUN:
            seen[q - p] = q + right
            if left + right >= LEAST:
                out.append((p - left, p + right, q - left, q + right))
                to = max(to, q + right)
    for p, m, q, n in np.unique(meets[(meets[:, 1] > 0) & (meets[:, 3] > 0)], axis=0).tolist():
        if any(s <= q and q + n <= e for _, _, s, e in out):
            continue
        if jaccard_reaches(set_x(p, m), set_y(q, n), PERCENT):
            out.append((p, p + m, q, q + n))
    return out


def _chars(raw: bytes) -> np.ndarray:
    """For each byte place the number of code points before it."""
    return np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))


def apart(x: np.ndarray, y: np.ndarray, exact: np.ndarray, found) -> np.ndarray:
    """The exact meets (place in x, in y) of which not all 50-word windows around are verified to be equal."""
    p, q = exact[:, 0], exact[:, 2]
    ok, side = np.zeros(len(p), bool), LEAST - RUN
    for a, b, f, g in found:
        if b - a == g - f:
            ok |= (p - q == a - f) & ((p - side >= a) | ((a == 0) & (f == 0) & (p >= 0))) & ((p + LEAST <= b) | ((b == len(x)) & (g == len(y)) & (p + RUN <= b)))
    return np.stack([p[~ok], q[~ok]], 1)


def around(doc: int, h: np.ndarray, at: np.ndarray, known=()) -> np.ndarray:
    """Entries of the windows of LEAST words that hold the runs at these places, but for those inside known spans."""
    w = np.unique(at[:, None] - np.arange(LEAST - RUN + 1)[None])
    w = w[(w >= 0) & (w + LEAST <= len(h))]
    for f, g in known:
        w = w[(w < f) | (w + LEAST > g)]
    out = np.zeros(len(w), ENTRY)
    if len(w):
        out["k"] = mix(mix((h[w[:, None] + np.arange(LEAST)[None]] * _AROUND).sum(1, dtype=np.uint64)) + _SALT[BANDS + 1])
        out["d"], out["p"] = doc, w
    return out


def _mixed(x: int) -> int:
    """`mix` of one number."""
    top = (1 << 64) - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & top
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & top
    return x ^ (x >> 31)


def line_id(doc: int, p: int) -> int:
    x = _mixed((_mixed(doc % (1 << 64)) + p) % (1 << 64))
    return x - (1 << 64) if x >= 1 << 63 else x


class Lines:
    """The paragraphs of a document by place and words: shingles, and what is told of them; each worked out once."""

    def __init__(self, h: np.ndarray):
        self.h, self.sets, self.facts = h, {}, {}

    def set(self, p: int, n: int) -> np.ndarray:
        if (p, n) not in self.sets:
            self.sets[p, n] = shingle_set(self.h[p : p + n])
        return self.sets[p, n]

    def of(self, p: int, n: int) -> tuple:
        """Number of shingles, signature, band keys and parities."""
        if (p, n) not in self.facts:
            s = self.set(p, n)
            low = (_PERM[:, None] * s[None]).min(1).reshape(BANDS, ROWS)
            keys = mix((low * _PERM[:ROWS]).sum(1, dtype=np.uint64) + _SALT[:BANDS])
            self.facts[p, n] = len(s), signature(s), keys.tobytes() + parity(s)
        return self.facts[p, n]


def line_row(doc: int, lines: Lines, p: int, n: int, up: int) -> tuple:
    """Of a paragraph: document, place, words, shingles, signature, the like it has before it (or itself), id, band keys and parities of its set."""
    size, sig, blob = lines.of(p, n)
    return doc, p, n, size, sig, up, line_id(doc, p), 0, 2, blob


def _judge(hub_text):
    raw = encode(hub_text)
    s, e, x = words(raw)
    at: list = []
    told: set = set()
    own_lines = Lines(x)

    def crowds(hub, member, y, meets, found, lines):
        out = []
        left = apart(x, y, meets[meets[:, 1] == 0], found)
        if len(left):
            blobs = [around(member, y, np.unique(left[:, 1]), [(f, g) for a, b, f, g in found if b - a == g - f])]
            if fresh := set(left[:, 0].tolist()) - told:
                told.update(fresh)
                r = runs(x, RUN)
                blobs.append(around(hub, x, np.flatnonzero(np.isin(r, r[sorted(fresh)]))))
            if blob := b"".join(b.tobytes() for b in blobs):
                out.append((0, 0, 0, 0, 0, 0, 0, 0, 1, blob))
        alike = set(found)
        for p, m, q, n in np.unique(meets[(meets[:, 1] > 0) & (meets[:, 3] > 0)], axis=0).tolist():
            if m == n and (x[p : p + m] == y[q : q + n]).all():
                continue
            if (p, m) not in told:
                told.add((p, m))
                out.append(line_row(hub, own_lines, p, m, line_id(hub, p)))
            out.append(line_row(member, lines, q, n, line_id(hub, p) if (p, p + m, q, q + n) in alike else line_id(member, q)))
        return out

    def look(hub, member, text, note):
        own = encode(text)
        ms, me, y = words(own)
        meets = np.frombuffer(bytes.fromhex(bytes(note).decode()), MEET).reshape(-1, 4).astype(np.int64)
        lines = Lines(y)
        found = common_spans(x, y, meets, (own_lines.set, lines.set))
        more = crowds(hub, member, y, meets, found, lines)
        if not found:
            return more
        if not at:
            at.append(_chars(raw))
        c, d = at[0], _chars(own)
        return [(hub, int(c[s[a]]), int(c[e[b - 1]]), b - a, member, int(d[ms[f]]), int(d[me[g - 1]]), g - f, 0, None) for a, b, f, g in found] + more

    return look


JUDGED = "a long, a_start long, a_end long, a_words long, b long, b_start long, b_end long, b_words long, kind int, more binary"


def _met(frames):
    for f in frames:
        meet = f[["p", "l", "q", "n"]].to_numpy().astype(MEET)
        yield pd.DataFrame({"hub": f.hub, "member": f.member, "meet": pd.Series([m.tobytes().hex() for m in meet], dtype=object)})


def _line_keys_of(frames):
    for f in frames:
        yield pd.DataFrame({"s": np.repeat(f.s.to_numpy(), BANDS), "k": np.concatenate([np.frombuffer(m[: 8 * BANDS], np.int64) for m in f.more] or [np.zeros(0, np.int64)])})


def _verified(meets: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """What _judge says of the pairs of documents with these meets."""
    pairs = meets.where("hub < member").groupBy("hub", "member").agg(F.concat_ws("", F.collect_list("meet")).cast("binary").alias("note"))
    return cut(with_texts(cut(pairs, f"{name}_pairs", "zstd"), docs, _judge, JUDGED), name)


def _lines(judged: DataFrame):
    """The paragraphs that differ from one they met (one row per place and like before it), and of each set the first paragraph: doc, p, l, s, n, id, more."""
    rows = judged.where("kind = 2").select(F.col("a").alias("doc"), F.col("a_start").alias("p"), F.col("a_end").alias("l"), F.col("a_words").alias("n"), F.col("b").alias("s"), F.col("b_start").alias("up"), F.col("b_end").alias("id"), "more")
    first = rows.groupBy("s").agg(F.min(F.struct("doc", "p", "l", "id", "n", "more")).alias("x")).select("s", "x.*")
    return rows.select("doc", "p", "l", "s", "up", "id").distinct(), cut(first, "first_lines")


def _named(rows: DataFrame, first: DataFrame) -> DataFrame:
    """sig and component of each set of shingles; sets that have no like before them are their own, but for the first of a component."""
    links = cut(rows.where("up <> id").select("up", F.col("s").alias("b"), "id"), "up")
    ids = rows.select(F.col("id").alias("up"), F.col("s").alias("a")).distinct()
    label = components(links.join(ids, "up").select("a", "b"))
    gone = links.select("id", F.lit(True).alias("gone")).distinct()
    all_ = first.select("s", "doc", "id").join(gone, "id", "left").join(label.withColumnRenamed("node", "s"), "s", "left")
    all_ = cut(all_.select("s", "doc", F.coalesce("gone", F.lit(False)).alias("gone"), F.coalesce("component", "s").alias("c")), "sets")
    base = all_.groupBy("c").agg(F.min_by("s", F.struct("gone", "doc", "s")).alias("base"))
    return cut(all_.join(base, "c").select(F.col("s").alias("sig"), F.when(F.col("gone"), F.col("base")).otherwise(F.col("s")).alias("component")), "named")


def _crowds(judged: DataFrame, docs: DataFrame, again, buckets: int) -> DataFrame:
    """What is found of those that met the first of a key only: see Crowds above."""
    scan = judged.where("kind = 1").select("more").mapInPandas(trimmed(again), "bucket long, blob binary, hub long, member long, meet string")
    meets = scan.groupBy("bucket").applyInPandas(_bucket, "hub long, member long, meet string")
    rows, first = _lines(judged)
    first_of = first.select("s", F.col("doc").alias("hub"), F.col("p").alias("fp"), F.col("l").alias("fl"))
    same = rows.select("doc", "p", "l", "s").distinct().join(first_of, "s").where("hub < doc").select("hub", F.col("fp").alias("p"), F.col("fl").alias("l"), F.col("doc").alias("member"), F.col("p").alias("q"), F.col("l").alias("n"))
    same = same.mapInPandas(_met, "hub long, member long, meet string")
    keys = first.select("s", "more").mapInPandas(_line_keys_of, "s long, k long").distinct()
    keys = keys.join(keys.groupBy("k").count().where("count > 2").select("k"), "k")
    hot = cut(keys.join(first.select("s", "n"), "s").select("k", "s", "n", F.lit(0).cast("long").alias("p")), "hot")
    sets = cut(first.select(F.col("s").alias("sig"), F.expr(f"substring(more, {8 * BANDS + 1})").alias("bits")), "bits")
    x = first.select(F.col("s").alias("a"), F.col("doc").alias("da"), F.col("p").alias("pa"), F.col("l").alias("la"))
    y = first.select(F.col("s").alias("b"), F.col("doc").alias("db"), F.col("p").alias("pb"), F.col("l").alias("lb"))

    def meets_of(pairs):
        u, v = F.struct(F.col("da").alias("d"), F.col("pa").alias("p"), F.col("la").alias("l")), F.struct(F.col("db").alias("d"), F.col("pb").alias("p"), F.col("lb").alias("l"))
        both = pairs.join(x, "a").join(y, "b").where("da <> db").select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))
        return both.select(F.col("u.d").alias("hub"), F.col("u.p").alias("p"), F.col("u.l").alias("l"), F.col("v.d").alias("member"), F.col("v.p").alias("q"), F.col("v.l").alias("n")).mapInPandas(_met, "hub long, member long, meet string")

    likely = cut(across(hot, _named(rows, first), sets, PERCENT, True), "likely")
    second = _verified(meets.union(same).union(meets_of(likely)), docs, "second")
    rows = rows.union(_lines(second)[0])
    late = cut(across(hot, _named(rows, first), sets, PERCENT, False).join(likely, ["a", "b"], "left_anti"), "late")
    return second if late.isEmpty() else second.union(_verified(meets_of(late), docs, "third"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per repeated passage of a document: doc_id, start, n_chars (code points), n_words (about, where spans overlap), class_id,
    first_doc (first document of the class) and removed (false for the first occurrence, which stays)."""
    rows, extra = keyed(docs.select("doc_id", "text"), "key")
    return doc_of(doc_of(passages_by_key(rows.select(F.col("key").alias("doc_id"), "text")), "doc_id", extra), "first_doc", extra)


def passages_by_key(docs: DataFrame) -> DataFrame:
    """The same for rows of which those with one doc_id have one text."""
    docs = docs.where("doc_id is not null and text is not null")
    size = about_chars(docs)
    buckets = max(4, size // (40 * BUCKET))
    scanned, again = _scan(buckets)
    scan = docs.mapInPandas(trimmed(scanned), "bucket long, blob binary, hub long, member long, meet string")
    meets = scan.groupBy("bucket").applyInPandas(_bucket, "hub long, member long, meet string")
    judged = _verified(meets, docs, "judged")
    if not judged.where("kind > 0").isEmpty():
        judged = judged.union(_crowds(judged, docs, again, buckets))
    spans = cut(judged.where("kind = 0").drop("kind", "more").distinct(), "spans")
    sides = spans.select(F.col("a").alias("doc_id"), F.col("a_start").alias("s"), F.col("a_end").alias("e"), F.col("a_words").alias("n"), F.lit(False).alias("removed")).union(
        spans.select("b", "b_start", "b_end", "b_words", F.lit(True))).distinct()

    def joined(df, keys):
        w = W.partitionBy(*keys).orderBy("s", "e")
        fresh = df.withColumn("x", F.max("e").over(w.rowsBetween(W.unboundedPreceding, -1))).withColumn("x", F.when(F.col("s") < F.col("x"), 0).otherwise(1))
        return fresh.withColumn("node", F.sum("x").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("x")

    placed = joined(sides, ["doc_id"])
    placed = cut(placed.withColumn("node", F.xxhash64("doc_id", "node")), "placed")
    where = placed.groupBy("doc_id", "s", "e").agg(F.first("node").alias("node"))
    ends = spans.select(F.col("a").alias("doc_id"), F.col("a_start").alias("s"), F.col("a_end").alias("e"), "b", "b_start", "b_end").join(where, ["doc_id", "s", "e"])
    ends = ends.select(F.col("node").alias("a"), F.col("b").alias("doc_id"), F.col("b_start").alias("s"), F.col("b_end").alias("e")).join(where, ["doc_id", "s", "e"])
    label = cut(components(ends.select("a", F.col("node").alias("b"))), "label")
    gone = joined(placed.where("removed").withColumnRenamed("node", "whole"), ["doc_id", "whole"]).groupBy("doc_id", "whole", "node").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))
    kept = placed.groupBy("doc_id", F.col("node").alias("whole")).agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"), F.max("removed").alias("removed")).where("not removed")
    rows = gone.select("doc_id", "whole", "s", "e", "n", F.lit(True).alias("removed")).union(kept.select("doc_id", "whole", "s", "e", "n", "removed"))
    rows = rows.join(label, rows.whole == label.node).select("doc_id", F.col("s").alias("start"), (F.col("e") - F.col("s")).alias("n_chars"), F.col("n").alias("n_words"), F.col("component").alias("class_id"), "removed")
    rows = cut(rows, "passages")
    first = rows.groupBy("class_id").agg(F.min("doc_id").alias("first_doc"))
    return with_each(rows, first, "class_id").select("doc_id", "start", "n_chars", "n_words", "class_id", "first_doc", "removed")


def without(text: str, spans: str) -> Column:
    """The text without these spans (start, n_chars), which don't overlap and come in order."""
    ends = F.transform(spans, lambda x: (x.start + x.n_chars).cast("int"))
    starts = F.transform(spans, lambda x: x.start.cast("int"))
    pieces = F.zip_with(F.concat(F.array(F.lit(0)), ends), F.concat(starts, F.array(F.length(text))), lambda a, b: F.substring(F.col(text), a + 1, b - a))
    return F.array_join(pieces, "")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the removed passages cut out of text and n_chars counted anew; a document of which only white space is left goes.

    All other columns and rows stay as they are, null texts and ids too."""
    key, doc, spans = (free_name(docs, n) for n in ("_key", "_doc", "_spans"))
    rows, _ = keyed(docs, key)
    found = passages_by_key(rows.select(F.col(key).alias("doc_id"), "text")).where("removed")
    gone = cut(found.groupBy(F.col("doc_id").alias(doc)).agg(F.array_sort(F.collect_list(F.struct("start", "n_chars"))).alias(spans)), "gone")
    out = rows.join(gone, rows[key] == gone[doc], "left")
    # a generator, so that the text is made once: a filter behind a plain column would make it again
    left = F.when(F.col(spans).isNull(), F.array(F.struct(F.col("text").alias("t"), F.lit(False).alias("c")))).otherwise(F.array(F.struct(without("text", spans).alias("t"), F.lit(True).alias("c"))))
    made = free_name(docs, "_made")
    out = out.withColumn(made, F.explode(left)).where(~F.col(made).c | F.col(made).t.rlike(r"\S")).withColumn("text", F.col(made).t)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(made).c, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
