"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

Two texts link when 100 * |A & B| >= 75 * |A | B| for their sets of 5-word shingles. The steps:

1. One pass gives each text's set size and a 64-bit signature of its set; texts with equal sets are one class from there
   on. The same pass counts shingles: a scope (some thousand documents of one task) reports those of two or more of its
   classes, and the sums rank the frequent ones. The ranking only orders shingles: an undercount costs time, not links.
2. A second pass sorts each set rare first (never reported, then by count; ties by hash) and keeps the prefix, size -
   ceil(0.75 * size) + 1 shingles: linked sets share one of them. Rare ones go to hash buckets, packed; there all pairs that
   pass the length and positional filters become candidates, each once a bucket. Groups are small there by construction.
   A suffix filter on a few hundred bits of each set then bounds the Hamming distance of a pair, before texts move.
3. A frequent shingle's members each meet the least of them (a star). Each text is first verified with the candidate it met
   most often, on whole texts with the suffix filter first, and components are built from these links.
4. Members of one frequent shingle that lie in different components meet, in blocks of bounded size: first each with the
   likeliest of the others, then, with new components, all that still lie apart, as do the other candidates. Each pair is
   verified once at most; none that could join two components is left out, and pairs inside one can't change them.

Rows per document: a text without words has no shingles and is linked with nothing; so is a null text. Repeated rows are
kept; rows of one doc_id with different texts are documents of their own. A null doc_id keeps its row, with a null component.
Very long texts are worked off in pieces. Other columns of the input are ignored; an empty table gives an empty one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.pairing import with_texts
from tidemark.llm.shared import as_text, cut, doc_of, keyed, let_go, longs, small, table, trimmed, with_each
from tidemark.llm.textnum import jaccard_reaches, mix, shingle_list, shingle_set, words, words_of

#: Shingles that a scope holds before it reports, about 16 MB.
SCOPE = 1_000_000
#: A shingle counts as frequent from this count on; the most frequent FREQUENT of them are sent to all tasks (about 1.5 MB).
LEAST_COUNT, FREQUENT = 12, 65_536
#: Members up to which a rare shingle's pairs are all made in its bucket; larger groups go the way of frequent shingles.
SMALL = 12
#: Prefix entries that a bucket holds on average, about 6 MB, and members of a frequent shingle in a block.
BUCKET, BLOCK = 250_000, 8_000
ENTRY = np.dtype([("t", "<u4"), ("u", "<u2"), ("s", "<i8"), ("n", "<u4"), ("p", "<u4")])


def least_shared(x, y, percent: int):
    return -(-percent * (x + y) // (100 + percent))


def signature(s: np.ndarray) -> int:
    """Of a sorted set of hashes; equal sets have equal ones."""
    return int(mix(mix(s) * np.uint64(3) + np.uint64(1)).sum() + np.uint64(len(s) * 0x9E3779B9)) - (1 << 63)


def parity(s: np.ndarray) -> bytes:
    """One bit for each hash value range: whether the set has an odd number there. About two bits an element."""
    m = min(max(256, 1 << (2 * len(s) - 1).bit_length()), 1 << 16)
    return np.packbits(np.bincount((s >> np.uint64(20)).astype(np.int64) & (m - 1), minlength=m) & 1, bitorder="little").tobytes()


def near_enough(x: bytes, nx: int, y: bytes, ny: int, percent: int) -> bool:
    """The suffix filter over the whole order: where the parities differ lies an element of only one set, so their
    number bounds the Hamming distance from below; linked sets differ in (100 - percent) / (100 + percent) of both sizes at most."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) != len(b):
        a, b = (v.reshape(-1, min(len(a), len(b))) for v in (a, b))
        a, b = (np.bitwise_xor.reduce(v, axis=0) for v in (a, b))
    return (100 + percent) * int(np.bitwise_count(a ^ b).sum()) <= (100 - percent) * (nx + ny)


def _counts(ids, sets) -> pd.DataFrame:
    """Of the shingles of two or more different sets."""
    h, c = np.unique(np.concatenate(list(sets.values())), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, int))
    h, c = h[c > 1], c[c > 1]
    doc, n, sig, bits = zip(*ids, strict=True)
    none = longs([None] * len(h))
    rows = pd.DataFrame({"doc_id": longs(doc), "n": n, "sig": longs(sig), "bits": bits, "h": longs([None] * len(n)), "c": 0})
    return pd.concat([rows, pd.DataFrame({"doc_id": none, "n": -1, "sig": none, "bits": None, "h": pd.array(h.view(np.int64), "Int64"), "c": c})])


def _survey(frames):
    let_go()
    ids, sets, held = [], {}, 0
    for f in frames:
        keys = f.doc_id.tolist()
        for i, _, _, h in words_of(f.text):
            s = shingle_set(h)
            sig = signature(s) if len(s) else None
            ids.append((keys[i], len(s), sig, parity(s) if len(s) else None))
            if len(s) and sig not in sets:
                sets[sig] = s
                held += len(s)
            if held >= SCOPE or len(ids) >= 100_000:
                yield _counts(ids, sets)
                ids, sets, held = [], {}, 0
    if ids:
        yield _counts(ids, sets)


def ordered_prefix(s: np.ndarray, known: np.ndarray, count: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a sorted set in rare-first order, and which of it are frequent. known: sorted, with counts."""
    if len(known):
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        often = np.where(known[at] == s, count[at], 0)
    else:
        often = np.zeros(len(s), np.int64)
    size = len(s) + (-percent * len(s) // 100) + 1
    pick = np.lexsort((s, often))[:size] if often.any() else np.arange(size)
    return s[pick], often[pick] > 0


def _prefixes(known, count, buckets, percent):
    def emit(held):
        tok, sig, n, p, hot = (np.concatenate(x) for x in zip(*held, strict=True))
        b = (tok >> np.uint64(48)) % np.uint64(buckets)
        e = np.empty(len(tok), ENTRY)
        e["t"], e["u"], e["s"], e["n"], e["p"] = tok & np.uint64(0xFFFFFFFF), (tok >> np.uint64(32)) & np.uint64(0xFFFF), sig, n, p
        cold = np.flatnonzero(~hot)
        cold = cold[np.argsort(b[cold], kind="stable")]
        edges = np.flatnonzero(np.diff(b[cold].astype(np.int64), prepend=-1, append=-1)) if len(cold) else []
        rows = [(int(b[cold[x]]), 0, e[cold[x:y]].tobytes()) for x, y in zip(edges[:-1], edges[1:], strict=True)]
        if hot.any():
            full = np.empty(int(hot.sum()), HOT)
            full["k"], full["s"], full["n"], full["p"] = tok[hot].view(np.int64), sig[hot], n[hot], p[hot]
            rows += [(int(full["s"][x] % buckets), 1, full[x : x + 5000].tobytes()) for x in range(0, len(full), 5000)]
        return pd.DataFrame(rows, columns=["bucket", "hot", "blob"])

    def run(frames):
        let_go()
        held, seen, total = [], set(), 0
        for f in frames:
            for _, _, _, h in words_of(f.text):
                s = shingle_set(h)
                if not len(s) or (sig := signature(s)) in seen:
                    continue
                seen.add(sig)
                tok, hot = ordered_prefix(s, known, count, percent)
                m = len(tok)
                held.append((tok, np.full(m, sig), np.full(m, len(s)), np.arange(m), hot))
                total += m
                if total >= SCOPE // 3:
                    yield emit(held)
                    held, seen, total = [], set(), 0
        if held:
            yield emit(held)

    return run


HOT = np.dtype([("k", "<i8"), ("s", "<i8"), ("n", "<u4"), ("p", "<u4")])


def passing(nx, px, ny, py, percent: int):
    """Length and positional filter for sets that share the shingles at these places of their orders."""
    nx, px, ny, py = (v.astype(np.int64) for v in (nx, px, ny, py))
    most = np.minimum(px, py) + 1 + np.minimum(nx - px - 1, ny - py - 1)
    return (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & (most >= least_shared(nx, ny, percent))


def _bucket_pairs(percent):
    def run(f):
        let_go()
        hot = [np.frombuffer(b, HOT) for b in f.blob[f.hot == 1]]
        out = []
        for h in hot:
            out.append(pd.DataFrame({"a": h["s"], "b": h["s"], "k": pd.array(h["k"], "Int64"), "n": h["n"].astype(np.int64), "p": h["p"].astype(np.int64)}))
        cold = [np.frombuffer(b, ENTRY) for b in f.blob[f.hot == 0]]
        if cold:
            e = np.concatenate(cold)
            key = (e["u"].astype(np.uint64) << np.uint64(32)) | e["t"]
            first = np.argsort(key, kind="stable")
            key = key[first]
            same = key[1:] == key[:-1]
            many = np.zeros(len(key), bool)
            many[1:] |= same
            many[:-1] |= same
            e, key = e[first[many]], key[many]
            order = np.lexsort((e["s"], key))
            e, key = e[order], key[order]
            fresh = np.ones(len(e), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (e["s"][1:] != e["s"][:-1])
            e, key = e[fresh], key[fresh]
            _, at, size = np.unique(key, return_inverse=True, return_counts=True)
            big = size[at] > SMALL
            out.append(pd.DataFrame({"a": e["s"][big], "b": e["s"][big], "k": pd.array(key[big].astype(np.int64), "Int64"), "n": e["n"][big].astype(np.int64), "p": e["p"][big].astype(np.int64)}))
            e, key = e[~big], key[~big]
            got = []
            step = 1
            while step < len(e) and (near := np.flatnonzero(key[step:] == key[:-step])).size:
                x, y = e[near], e[near + step]
                ok = passing(x["n"], x["p"], y["n"], y["p"], percent)
                got.append(np.stack([x["s"][ok], y["s"][ok]], 1))
                if sum(map(len, got)) > 2_000_000:
                    got = [np.unique(np.concatenate(got), axis=0)]
                step += 1
            if got:
                pairs = np.unique(np.concatenate(got), axis=0)
                out.append(pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "k": pd.array([None] * len(pairs), "Int64"), "n": 0, "p": 0}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "k": [], "n": [], "p": []})

    return run


def _linked(percent):
    def judge(hub_text):
        a = shingle_set(words((hub_text or "").encode("utf-8", "surrogatepass"))[2])

        def look(hub, member, text, _):
            b = shingle_set(words((text or "").encode("utf-8", "surrogatepass"))[2])
            return [(hub, member)] if jaccard_reaches(a, b, percent) else []

        return look

    return judge


def parity_slack(bits, i, j, sizes, percent: int) -> np.ndarray:
    """For the pairs (i[k], j[k]) of rows a number that is below 0 where near_enough is false, and larger for likelier links."""
    length = np.array([len(b) for b in bits])
    low = np.minimum(length[i], length[j])
    slack = np.zeros(len(i), np.int64)
    for m in np.unique(low).tolist():
        used = np.flatnonzero(length >= m)
        place = np.zeros(len(bits), np.int64)
        place[used] = np.arange(len(used))
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(bits[r], np.uint64).reshape(-1, m // 8), axis=0) for r in used])
        for at in np.array_split(np.flatnonzero(low == m), 1 + (low == m).sum() * m // (1 << 24)):
            apart = np.bitwise_count(folded[place[i[at]]] ^ folded[place[j[at]]]).sum(1, dtype=np.int64)
            slack[at] = (100 - percent) * (sizes[i[at]] + sizes[j[at]]) - (100 + percent) * apart
    return slack


def _across(percent, best):
    """Pairs of different components among the members of a frequent shingle, block against block; rows come sorted.

    best: only the likeliest pair of each row, one with the largest component if there is any."""

    def pairs(f, x, y, same):
        s, c, n, p = (f[v].to_numpy(np.int64) for v in ("s", "c", "n", "p"))
        out = []
        for at in range(0, len(x), 256):
            q = x[at : at + 256]
            far = c[q][:, None] != c[y][None]
            if same:
                far &= s[q][:, None] < s[y][None]
            i, j = np.nonzero(far)
            i, j = q[i], y[j]
            ok = passing(n[i], p[i], n[j], p[j], percent)
            i, j = i[ok], j[ok]
            if len(i):
                slack = parity_slack(f.bits.to_numpy(), i, j, n, percent)
                ok = slack >= 0
                if best and ok.any():
                    order = np.lexsort((j, -slack, i))
                    order = order[ok[order]]
                    ok = order[np.unique(i[order], return_index=True)[1]]
                out.append(np.stack([s[i[ok]], s[j[ok]]], 1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)

    def close(held):
        f = pd.concat(held, ignore_index=True)
        own, other = np.flatnonzero(f.side == 0), np.flatnonzero(f.side == 1)
        if len(other):
            return pairs(f, own, other, False)
        names, times = np.unique(f.c, return_counts=True)
        most = (f.c == names[times.argmax()]).to_numpy()  # members of the largest component needn't meet each other
        rest = np.flatnonzero(~most)
        got = pairs(f, rest, np.flatnonzero(most), False)
        if best:
            rest = rest[~np.isin(f.s.to_numpy()[rest], got)]
        return np.concatenate([got, pairs(f, rest, rest, True)])

    def run(frames):
        let_go()
        at, held = None, []
        for f in frames:
            for key, g in f.groupby(["k", "i", "j"], sort=False):
                if at is not None and key != at:
                    if len(got := close(held)):
                        yield pd.DataFrame({"a": got.min(1), "b": got.max(1)})
                    held = []
                at = key
                held.append(g)
        if held and len(got := close(held)):
            yield pd.DataFrame({"a": got.min(1), "b": got.max(1)})

    return run


def filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, w) whose sizes and parities allow a link."""

    def run(frames):
        for f in frames:
            rows = zip(f.x, f.nx, f.y, f.ny, strict=True)
            yield f.loc[[100 * min(nx, ny) >= percent * max(nx, ny) and near_enough(x, nx, y, ny, percent) for x, nx, y, ny in rows], ["a", "b", "w"]]

    ends = pairs.join(classes.select(F.col("sig").alias("a"), F.col("n").alias("nx"), F.col("bits").alias("x")), "a").join(
        classes.select(F.col("sig").alias("b"), F.col("n").alias("ny"), F.col("bits").alias("y")), "b")
    return ends.select("a", "b", "w", "nx", "x", "ny", "y").mapInPandas(trimmed(run), "a long, b long, w long")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class signatures whose texts link."""
    ends = pairs.join(classes.select(F.col("sig").alias("a"), F.col("rep").alias("hub")), "a").join(classes.select(F.col("sig").alias("b"), F.col("rep").alias("member")), "b")
    return with_texts(ends.select("hub", "member", F.lit(None).cast("binary").alias("note")), docs, _linked(percent), "a long, b long", noted=False)


def named_by(classes: DataFrame, links: DataFrame) -> DataFrame:
    """sig and component (smallest doc_id) of each class."""
    label = components(links)
    return cut(classes.join(label, classes.rep == label.node, "left").select("sig", F.coalesce("component", "rep").alias("component")), "named")


def across(hot: DataFrame, named: DataFrame, classes: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a frequent shingle and pass all filters. hot: k, s, n, p."""
    members = hot.distinct().join(named.select(F.col("sig").alias("s"), F.col("component").alias("c")), "s")
    apart = members.groupBy("k").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("m")).where("x <> y").select("k", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    members = members.join(small(cut(apart, "apart")), "k").join(classes.select(F.col("sig").alias("s"), "bits"), "s").withColumn("i", F.pmod(F.xxhash64("s"), F.col("blocks")))
    members = cut(members, "members")
    kept = ["s", "c", "n", "p", "bits"]
    within = members.select("k", "i", F.col("i").alias("j"), *kept, F.lit(0).alias("side"))
    between = members.select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o"), "i", *kept).where("o <> i").select(
        "k", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"), *kept, F.when(F.col("o") > F.col("i"), 0).otherwise(1).alias("side"))
    rows = within.union(between).repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
    return rows.mapInPandas(trimmed(_across(percent, best)), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for each row of docs (doc_id, text)."""
    rows, extra = keyed(docs.select("doc_id", "text"), "key")
    found = components_by_key(rows.select(F.col("key").alias("doc_id"), "text"), percent)
    if extra is None:
        return found
    found = doc_of(cut(found, "by_key"), "doc_id", extra).withColumnRenamed("component_id", "c")
    low = found.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return with_each(found.where("c is not null"), low, "c").drop("c").unionByName(found.where("c is null").withColumnRenamed("c", "component_id"))


def components_by_key(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The same for rows of which those with one doc_id have one text."""
    survey = cut(docs.select(as_text("doc_id"), "text").mapInPandas(trimmed(_survey), "doc_id long, n long, sig long, bits binary, h long, c long"), "survey")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = survey.where("n >= 0")
    frequent = survey.where("n < 0").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= LEAST_COUNT).orderBy(F.desc("c"), "h").limit(FREQUENT).toPandas()
    known = frequent.h.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    known, count = known[order], frequent.c.to_numpy(np.int64)[order]
    classes = cut(rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // (4 * BUCKET)))
    shared = docs.where("doc_id is not null").mapInPandas(trimmed(_prefixes(known, count, buckets, percent)), "bucket long, hot int, blob binary")
    found = cut(shared.groupBy("bucket").applyInPandas(_bucket_pairs(percent), "a long, b long, k long, n long, p long"), "found")
    hot = found.where("k is not null").select("k", F.col("a").alias("s"), "n", "p")
    stars = hot.join(small(cut(hot.groupBy("k").agg(F.min("s").alias("m")), "least")), "k").where("s <> m").select(F.col("m").alias("a"), F.col("s").alias("b"))
    pairs = found.where("k is null").select("a", "b").union(stars).groupBy("a", "b").agg(F.count("*").alias("w"))
    pairs = cut(filtered(pairs, classes, percent), "pairs")
    first = cut(pairs.groupBy("b").agg(F.max_by("a", F.struct("w", "a")).alias("a")).select("a", "b"), "first")
    links = cut(verified(first, classes, docs, percent), "links")
    named = named_by(classes, links)
    fresh = cut(across(hot, named, classes, percent, True).join(first, ["a", "b"], "left_anti"), "fresh")
    if not fresh.isEmpty():
        links = cut(links.union(verified(fresh, classes, docs, percent)), "links")
        named = named_by(classes, links)
    done = first.union(fresh)
    ends = (named.select(F.col("sig").alias(x), F.col("component").alias("c" + x)) for x in "ab")
    apart = pairs.select("a", "b").join(next(ends), "a").join(next(ends), "b").where("ca <> cb").select("a", "b")
    late = cut(across(hot, named, classes, percent, False).union(apart).distinct().join(done, ["a", "b"], "left_anti"), "late")
    if not late.isEmpty():
        named = named_by(classes, cut(links.union(verified(late, classes, docs, percent)), "links"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(named, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
