"""Benchmark decontamination by template canonicalisation.

A token is a run of letters and digits. Tokens with a digit become a number slot, a unit behind a number becomes a unit slot,
a capitalised word inside a sentence becomes a name slot; neighbouring numbers or names are one slot. Windows of 8 such tokens,
at least 4 of them literal words, are hashed and joined with the benchmark's windows. In each place where a document follows an
item (the windows of one diagonal) the slot values must be consistent: each value of the item stands for one value of the
document throughout (the same one in verbatim copies, another in re-parameterised ones); windows against the majority of
their place don't count, other copies in the document have no say. A document holds an
item if a run of 13 tokens of it is covered on one diagonal; of an item of up to 13 tokens all but two, 8 at least.

Items that the windows can't tell (up to 13 tokens, or too few literal words for a run of 13) are also looked for as they are: all
their words, case aside, or any 13 of them in a row. Items of up to 13 tokens are also looked for without their first token,
whose kind depends on what stands before it, if 4 literal words are left.

A bitmap of fixed size (4,194,304 bits) of the benchmark's window hashes goes to all tasks, so only windows that may match
leave a document. An item is held verbatim if all its tokens, values too, are found in order in one place, case aside (for an item of more than 13
words that only runs of 13 words tell, this isn't said). Items of one item_id and different texts are one item. Null and empty texts match nothing, and so do null ids; an item of one word matches all documents
that have the word. Repeated rows count once. Other columns are ignored."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, small, table, trimmed
from tidemark.llm.textnum import encode, mix, runs, series, words

WINDOW, LITERAL, RUN, BITS = 8, 4, 13, 1 << 22
#: Fixed list of unit words, lower case.
UNITS = (
    "km m cm mm mile miles foot feet ft inch inches yard yards kg g mg gram grams pound pounds lb lbs ounce ounces oz ton tons tonnes "
    "l ml litre litres liter liters gallon gallons second seconds sec s minute minutes min hour hours h day days week weeks month months year years "
    "percent dollar dollars usd euro euros eur cent cents degree degrees celsius fahrenheit kelvin watt watts w kw volt volts v amp amps joule joules j "
    "byte bytes kb mb gb tb hz khz mhz ghz mph kmh"
).split()
_PARTED = np.ones(256, bool)
_PARTED[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_DIGIT, _UPPER, _LOWER, _STOP = (np.zeros(256, bool) for _ in range(4))
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER[ord("a") : ord("z") + 1] = True
_LOWER[0x80:] = True
_STOP[[ord(c) for c in ".!?:;|\n"]] = True
_UNIT = np.sort(words(" ".join(UNITS).encode(), _PARTED)[2])
NUMBER, UNIT, NAME = 1, 2, 3
_SLOT = series(4, 55)
_WIDTH = series(2 * RUN + 1, 66)


def _before(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Canonical token hashes, kinds (0: literal) and value hashes; hashes of the words as they are, case aside, and each token's first word."""
    raw = encode(text)
    start, end, h = words(raw, _PARTED)
    if not len(h):
        return h, np.zeros(0, np.int8), h, h, np.zeros(0, np.int64)
    a = np.frombuffer(raw, np.uint8)
    digits, stops = _before(_DIGIT[a]), _before(_STOP[a])
    kind = np.where(digits[end] > digits[start], NUMBER, 0).astype(np.int8)
    last = np.concatenate(([0], kind[:-1]))
    kind[(last == NUMBER) & (kind == 0) & np.isin(h, _UNIT)] = UNIT
    inside = np.concatenate(([False], stops[start[1:]] == stops[end[:-1]]))
    second = np.minimum(start + 1, len(a) - 1)
    kind[(kind == 0) & inside & (end - start > 1) & _UPPER[a[start]] & _LOWER[a[second]]] = NAME
    fresh = np.ones(len(kind), bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] != NUMBER) & (kind[1:] != NAME))
    at = np.flatnonzero(fresh)
    value = np.add.reduceat(h, at)
    kind = kind[at]
    return np.where(kind > 0, _SLOT[kind], value), kind, value, h, at


def windows(text: str | None):
    """Places and hashes of the windows, canonical tokens, a function that packs the slots of a window (place in it and value), the words, and a function
    that gives the word before a token (0 if none)."""
    c, kind, value, raw, first = template(text)
    h = runs(c, WINDOW)
    literal = _before(kind == 0)
    at = np.flatnonzero(literal[WINDOW:] - literal[: len(literal) - WINDOW] >= LITERAL) if len(h) else np.zeros(0, np.int64)

    def slots(p: int, width: int = WINDOW) -> bytes:
        k = np.flatnonzero(kind[p : p + width])
        return b"".join(bytes([j]) + value[p + j].tobytes() for j in k.tolist()) if len(k) else b""

    def before(p: int) -> int:
        return int(raw[first[p] - 1].view(np.int64)) if first[p] else 0

    return at, h[at], c, slots, raw, before


def least(n: int) -> int:
    """Tokens in a row by which the windows tell an item of n tokens."""
    return RUN if n > RUN else min(n, max(WINDOW, n - 2))


def strips(c: np.ndarray, raw: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of so many canonical tokens, or (below 0) of so many words as they are."""
    return mix(runs(c if width > 0 else raw, abs(width)) + _WIDTH[width + RUN])


def item_strips(at: np.ndarray, c: np.ndarray, raw: np.ndarray, slots) -> list[tuple[int, int]]:
    """Place and width of the strips by which an item is looked for besides its windows."""
    n, out = len(c), []
    if len(raw) and (n <= RUN or longest_run([(p, p) for p in at.tolist()]) < RUN):
        width = min(RUN, len(raw))
        out += [(p, -width) for p in range(len(raw) - width + 1)]
    if 1 < n <= RUN and n - 1 - len(slots(1, n - 1)) // 9 >= LITERAL:
        out.append((1, n - 1))
    return out


def _items(frames):
    for f in frames:
        rows = []
        for item, text in zip(f.item_id.tolist(), f.text, strict=True):
            at, h, c, slots, raw, before = windows(text)
            rows += [(int(item), int(p), int(k), len(c), slots(p), 0, before(p)) for p, k in zip(at.tolist(), h.view(np.int64).tolist(), strict=True)]
            for p, width in item_strips(at, c, raw, slots):
                rows.append((int(item), p, int(strips(c, raw, width)[p].view(np.int64)), len(c), slots(p, width) if width > 0 else b"", width, 0))
        yield pd.DataFrame(rows, columns=["item_id", "item_at", "k", "item_tokens", "item_slots", "width", "item_before"])


def _hits(bitmap: np.ndarray, widths: list[int]):
    def known(h):
        bit = (h & np.uint64(BITS - 1)).astype(np.int64)
        return np.flatnonzero(bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).tolist()

    def run(frames):
        for f in frames:
            rows = []
            for doc, text in zip(f.doc_id.tolist(), f.text, strict=True):
                at, h, c, slots, raw, before = windows(text)
                rows += [(int(doc), int(at[x]), int(h[x].view(np.int64)), slots(at[x]), before(at[x])) for x in known(h)]
                for width in widths:
                    h = strips(c, raw, width)
                    found = known(h)
                    if width < 0:  # words as they are have no slots: one place says all
                        found = [found[x] for x in np.unique(h[found], return_index=True)[1].tolist()] if found else []
                    rows += [(int(doc), x, int(h[x].view(np.int64)), slots(x, width) if width > 0 else b"", 0) for x in found]
            yield pd.DataFrame(rows, columns=["doc_id", "doc_at", "k", "doc_slots", "doc_before"])

    return run


def _values(raw: bytes) -> dict[int, bytes]:
    return {raw[x]: raw[x + 1 : x + 9] for x in range(0, len(raw), 9)}


def consistent(matches) -> tuple[list[tuple[int, int]], bool]:
    """The (document place, item place) whose slots agree with the majority's substitution, and whether all values are the same."""
    votes: dict[bytes, Counter] = defaultdict(Counter)
    read = [(p, q, _values(a), _values(b)) for p, q, a, b in matches]
    for _, _, a, b in read:
        for j in b:
            votes[b[j]][a.get(j, b"")] += 1
    chosen = {v: min(c, key=lambda x: (-c[x], x)) for v, c in votes.items()}
    kept = [(p, q) for p, q, a, b in read if all(chosen[b[j]] == a.get(j) for j in b)]
    return kept, all(a == b for _, _, a, b in read)


def longest_run(kept) -> int:
    """Of tokens covered in a row by windows on one diagonal."""
    best = at = run = 0
    diagonal = None
    for p, q in sorted(kept, key=lambda x: (x[0] - x[1], x[1])):
        if p - q == diagonal and q <= at + WINDOW:
            run += q - at
        else:
            diagonal, run = p - q, WINDOW
        at = q
        best = max(best, run)
    return best


def held(matches, least: int, tokens: int = 0) -> tuple[set[int], int, bool] | None:
    """Item places of the windows and longest run of the places that hold the item, and whether one is verbatim; each place is judged alone.

    A match is place, item place, slots, item slots, for a strip its width, and whether the words before are the same. An item's first token is of another kind where
    a document has it inside a sentence; then that word is the same if it is the one before the item's second token."""
    places, begun = defaultdict(list), set()
    at, best, verbatim = set(), 0, False
    for *m, width, alike in ((*m, 0, False)[:6] if len(m) == 4 else (*m, False)[:6] for m in matches):
        if not width:
            places[m[0] - m[1]].append(m)
            if m[1] == 1 and alike:
                begun.add(m[0] - m[1])
        elif width < 0 or consistent([m])[0]:
            at, best, verbatim = at | {m[1]}, max(best, abs(width)), verbatim or -RUN < width < 0
    for diagonal, own in places.items():
        kept, same = consistent(own)
        if (run := longest_run(kept)) >= least:
            at |= {q for _, q in kept}
            best, verbatim = max(best, run), verbatim or same and run + (diagonal in begun and min(q for _, q in kept) > 0) >= tokens > 0
    return (at, best, verbatim) if at else None


def _judge(frames):
    """Judges the matches of one place of a document and item; a row for each item place that is held."""
    for f in frames:
        rows = []
        for doc, item, n, matches in zip(f.doc_id, f.item_id, f.item_tokens, f.matches, strict=True):
            found = held([(m["doc_at"], m["item_at"], bytes(m["doc_slots"]), bytes(m["item_slots"]), m["width"], m["alike"]) for m in matches], least(n), n)
            if found:
                rows += [(doc, item, n, q, *found[1:]) for q in found[0]]
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "item_tokens", "item_at", "longest_run", "verbatim"])


#: Windows of items (some 200 bytes each) that are sent to all tasks; more are joined by shuffle.
ITEMS_SENT = 200_000


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, item_tokens, windows, longest_run, verbatim."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = cut(items.mapInPandas(_items, "item_id long, item_at int, k long, item_tokens int, item_slots binary, width int, item_before long"), "items")
    widths = sorted(items.where("width <> 0").select("width").distinct().toPandas().width.tolist())
    bit = items.select(F.col("k").bitwiseAND(BITS - 1).cast("int").alias("bit")).distinct().toPandas().bit.to_numpy(np.int64)
    bitmap = np.packbits(np.bincount(bit, minlength=BITS).astype(bool), bitorder="little")
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = docs.mapInPandas(trimmed(_hits(bitmap, widths)), "doc_id long, doc_at int, k long, doc_slots binary, doc_before long")
    # a place (the matches of one diagonal) has as many rows as the item has windows at most
    both = hits.join(small(items, ITEMS_SENT), "k").groupBy("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).agg(
        F.max("item_tokens").alias("item_tokens"), F.collect_set(F.struct("doc_at", "item_at", "doc_slots", "item_slots", "width", (F.col("doc_before") == F.col("item_before")).alias("alike"))).alias("matches"))
    held_ = both.drop("diagonal").mapInPandas(_judge, "doc_id long, item_id long, item_tokens int, item_at int, longest_run int, verbatim boolean")
    return held_.groupBy("doc_id", "item_id").agg(
        F.max("item_tokens").alias("item_tokens"), F.count_distinct("item_at").cast("int").alias("windows"), F.max("longest_run").alias("longest_run"), F.max("verbatim").alias("verbatim"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
