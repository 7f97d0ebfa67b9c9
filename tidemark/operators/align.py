"""Alignment of each peptide to one reference, and codons carried along.

A row depends on its own sequences and the reference only, so distinct peptides are aligned once, in Arrow batches, and joined
back. The reference is a profile of match, insert and delete states: a residue of the query is scored by the log-odds of having come from the
reference's residue against chance, a gap by those of opening, going on and closing it. Ends are local: the query may go on at both ends for nothing, and
an alignment may leave out any number of the reference's residues at an end for the price of opening a gap. Only reference columns are kept. The best path is
that of Viterbi's algorithm, for many peptides at once, one array a reference column. Ties prefer a match to a gap, the shorter insert, the alignment that
ends in the later column, then the earlier place in the query.

A long query is compared with the reference only around common words, if all its best alignments can be proven to lie there: see `_windows`."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The share of each residue in proteins, and groups of residues that replace each other.
SHARE = {
    "A": 0.074, "R": 0.052, "N": 0.045, "D": 0.054, "C": 0.025, "Q": 0.034, "E": 0.054, "G": 0.074, "H": 0.026, "I": 0.068,
    "L": 0.099, "K": 0.058, "M": 0.025, "F": 0.047, "P": 0.039, "S": 0.057, "T": 0.051, "W": 0.013, "Y": 0.032, "V": 0.073,
}
GROUPS = ["ILVM", "FWY", "KRH", "DE", "NQ", "ST", "AG", "C", "P"]
#: A residue stays what it is with this probability; of the changes this share stays in its group; any other letter has this share of proteins.
STAYS, NEAR, OTHER_SHARE = 0.35, 0.4, 0.02
#: Probabilities of beginning a gap and of going on with it.
P_OPEN, P_EXTEND = 0.02, 0.4


def _units(odds: float) -> int:
    """Log-odds in tenths of half a bit."""
    return round(20 * np.log2(odds))


#: What an opened, a longer and a closed gap cost, against going from match to match; and leaving out an end of the reference.
_MATCH = 1 - 2 * P_OPEN
OPEN, EXTEND, CLOSE = _units(_MATCH / P_OPEN), _units(1 / P_EXTEND), _units(_MATCH / (1 - P_EXTEND))
END = OPEN
LOW = -(1 << 29)
#: Cells of a column that are worked on at once, bytes of ways that are held at once, and the least and greatest length of words by which long queries are searched.
CELLS, WAYS, WORD, LONGEST_WORD = 32_768, 1 << 26, 4, 8
M, I, D, DONE = range(4)


def longest_query(reference: int) -> int:
    """Peptides longer than this aren't aligned."""
    return max(reference + 100, 20 * reference)


def coded(s: str) -> np.ndarray:
    """A byte a letter; 127 for all letters beyond ASCII."""
    return np.minimum(np.frombuffer(s.encode("utf-32-le"), "<u4"), 127).astype(np.uint8)


def emissions(letter: int) -> np.ndarray:
    """Scores of all 128 letters against one of the reference; X and letters beyond ASCII are chance on either side."""
    own, out = chr(letter), np.zeros(128, np.int32)
    group = next((g for g in GROUPS if own in g), own)
    together = sum(SHARE.get(c, OTHER_SHARE) for c in group)
    for k in range(1, 127):
        share = SHARE.get(chr(k), OTHER_SHARE)
        p = STAYS * (k == letter) + (1 - STAYS) * (NEAR * (chr(k) in group) * share / together + (1 - NEAR) * share)
        out[k] = _units(p / share)
    out[[ord("X"), 127]] = 0
    out[0] = LOW  # behind the end of a query
    return out if own != "X" and letter < 127 else np.where(out == LOW, LOW, 0).astype(np.int32)


class Profile:
    def __init__(self, reference: str):
        self.text, self.letters = reference, coded(reference)
        self.n = len(self.letters)
        self.tables = {int(a): emissions(int(a)) for a in np.unique(self.letters)}
        own = np.array([self.tables[a][a] for a in self.letters.tolist()], np.int64)
        self.most = int(own.sum())
        #: The least loss of a column that isn't an unchanged residue.
        self.loss = min((int(t[a] - np.delete(t, [0, a]).max()) for a, t in self.tables.items()), default=0)


def _words(letters: np.ndarray, size: int) -> np.ndarray:
    if len(letters) < size:
        return np.zeros(0, np.int64)
    return sum(letters[k : len(letters) - size + 1 + k].astype(np.int64) << (7 * k) for k in range(size))


def _diagonals(profile: Profile, q: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a query less those in the reference of all common words, and how many words have each."""
    words, own = _words(q, size), _words(profile.letters, size)
    order = np.argsort(own, kind="stable")
    low, high = (np.searchsorted(own[order], words, side) for side in ("left", "right"))
    times = high - low
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.unique(np.repeat(np.arange(len(words)), times) - order[np.repeat(low, times) + nth], return_counts=True)


class _Paths:
    """The table of best paths of some queries (rows of q, 0 behind the end), column by column."""

    def __init__(self, profile: Profile, q: np.ndarray):
        self.profile, self.scores = profile, {a: t[q] for a, t in profile.tables.items()}
        self.shape = (len(q), q.shape[1] + 1)
        self.steps = EXTEND * np.arange(self.shape[1], dtype=np.int32)

    def first(self) -> tuple[np.ndarray, ...]:
        return tuple(np.full(self.shape, LOW, np.int32) for _ in range(3))

    def column(self, i: int, match: np.ndarray, insert: np.ndarray, delete: np.ndarray):
        """The scores of column i's states by the number of residues used, and the ways: bits for a match from a gap, from a delete, from the start; for a
        delete that goes on, and an insert that does."""
        gap = np.maximum(insert, delete)
        gap -= CLOSE
        ways = (gap > match).view(np.uint8)
        ways |= (delete > insert).view(np.uint8) << 1
        before, start = np.maximum(match, gap), -END if i else 0
        ways |= (before < start).view(np.uint8) << 2
        np.maximum(before, start, out=before)
        new = np.full(self.shape, LOW, np.int32)
        np.add(before[:, :-1], self.scores[int(self.profile.letters[i])], out=new[:, 1:])
        opened, longer = match - OPEN, delete - EXTEND
        ways |= (longer > opened).view(np.uint8) << 3
        np.maximum(opened, longer, out=opened)
        raised = new + self.steps
        reached = np.maximum.accumulate(raised, axis=1)
        ways[:, 1:] |= (reached > raised)[:, :-1].view(np.uint8) << 4
        added = np.full(self.shape, LOW, np.int32)
        np.subtract(reached[:, :-1], self.steps[:-1] + OPEN, out=added[:, 1:])
        return (new, added, opened), ways

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, last column, and the query's place of each residue of the reference (or -1). Ways are held as far as they may be; else some columns
        are kept, and those between are made again on the way back."""
        n, rows = self.profile.n, len(self.scores[int(self.profile.letters[0])])
        whole = n * self.shape[0] * self.shape[1] <= WAYS
        width = n if whole else max(1, int(n**0.5))
        score, last, used = np.full(rows, LOW), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        states, kept, ways = self.first(), {}, []
        for i in range(n):
            if i % width == 0:
                kept[i] = states
            states, way = self.column(i, *states)
            if whole:
                ways.append(way)
            at = states[0].argmax(axis=1)
            value = states[0][np.arange(rows), at] - (0 if i == n - 1 else END)
            better = value >= score
            score, last, used = np.where(better, value, score), np.where(better, i, last), np.where(better, at, used)
        places, state = np.full((rows, n), -1), np.full(rows, M)
        for begin in sorted(kept, reverse=True):
            states = kept.pop(begin)
            if not whole:
                ways = []
                for i in range(begin, min(begin + width, n)):
                    states, way = self.column(i, *states)
                    ways.append(way)
            for i in range(begin + len(ways) - 1, begin - 1, -1):
                state, used = _back(ways[i - begin], state, used, last >= i, places[:, i])
        return score, last, places


def _back(way: np.ndarray, state: np.ndarray, used: np.ndarray, begun: np.ndarray, places: np.ndarray):
    """One column back: the states and residues used before it; fills in its places."""
    rows = np.arange(len(state))
    deleted = begun & (state == D)
    inserted = begun & (state == I)
    while inserted.any():
        longer = inserted & ((way[rows, used] & 16) > 0)
        used = used - inserted
        state = np.where(inserted & ~longer, M, state)
        inserted = longer
    matched = begun & (state == M)
    used = used - matched
    places[matched] = used[matched]
    w = way[rows, used]
    came = np.where(w & 4, DONE, np.where(w & 1, np.where(w & 2, D, I), M))
    return np.where(matched, came, np.where(deleted, np.where(w & 8, D, M), state)), used


def _run(profile: Profile, queries: list[np.ndarray]):
    """(score, last column, places) of each query; queries of like length are worked on together."""
    out: list = [None] * len(queries)
    order, k = sorted(range(len(queries)), key=lambda x: -len(queries[x])), 0
    while k < len(order):
        m = len(queries[order[k]])
        some = order[k : k + max(1, CELLS // (m + 1))]
        q = np.zeros((len(some), m), np.uint8)
        for r, x in enumerate(some):
            q[r, : len(queries[x])] = queries[x]
        for x, *found in zip(some, *_Paths(profile, q).best(), strict=True):
            out[x] = found
        k += len(some)
    return out


def _guess(profile: Profile, q: np.ndarray) -> tuple[int, int] | None:
    """Of a long query the part around the diagonal with most common words; None if it isn't long or has none."""
    if len(q) <= 2 * profile.n + 256 or profile.loss <= 0:
        return None
    diagonals, times = _diagonals(profile, q, WORD)
    if not len(diagonals):
        return None
    middle = int(diagonals[times.argmax()])
    return max(0, middle - 64), min(len(q), middle + profile.n + 64)


def _windows(profile: Profile, q: np.ndarray, score: int) -> list[tuple[int, int]] | None:
    """Parts of a query that hold all its alignments that score as much or more, each in one part; None if that can't be told.

    Such an alignment loses at most `most` - score, hence has at most e = (most - score) / loss columns that aren't unchanged residues and at most e inserts;
    so its unchanged residues lie in e + 1 runs at most, one of which is a word of k if there are more than (k - 1)(e + 1) of them. It holds a common word of the
    greatest such length, then, and no residue further from the word's diagonal than an insert may be long."""
    lost = profile.most - score
    e, reach = lost // profile.loss, lost // EXTEND + 1
    size = min(LONGEST_WORD, (profile.n - e - 1) // (e + 1) + 1)
    if size < WORD:
        return None
    out: list[tuple[int, int]] = []
    for d in _diagonals(profile, q, size)[0].tolist():
        lo, hi = max(0, d - reach), min(len(q), d + profile.n + reach)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        elif lo < hi:
            out.append((lo, hi))
    return out


def align_all(profile: Profile, queries: list[str]) -> list[np.ndarray]:
    """For each query and residue of the reference the place of the query's residue, or -1. A query that holds the reference needs no table."""
    out: list = [np.full(profile.n, -1) for _ in queries]
    left, guessed = {}, {}
    for x, text in enumerate(queries):
        if text and profile.n:
            if "X" not in profile.text and (at := text.find(profile.text)) >= 0:
                out[x] = np.arange(at, at + profile.n)
            else:
                left[x] = coded(text)
                if found := _guess(profile, left[x]):
                    guessed[x] = found
    parts = []
    for (x, (lo, hi)), (score, _, places) in zip(guessed.items(), _run(profile, [left[x][lo:hi] for x, (lo, hi) in guessed.items()]), strict=True):
        windows = _windows(profile, left[x], int(score))
        if not windows:
            continue
        q = left.pop(x)
        if lo <= windows[0][0] and windows[-1][1] <= hi:
            out[x] = np.where(places >= 0, places + lo, -1)
        else:
            parts += [(x, a, q[a:b]) for a, b in windows]
    parts += [(x, 0, q) for x, q in left.items()]
    best: dict = {}
    for (x, lo, _), (score, last, places) in zip(parts, _run(profile, [q for _, _, q in parts]), strict=True):
        rank = (int(score), int(last), -lo)
        if x not in best or rank > best[x]:
            best[x], out[x] = rank, np.where(places >= 0, places + lo, -1)
    return out


def align(reference: str, query: str) -> np.ndarray:
    return align_all(Profile(reference), [query])[0]


def _texts(places: np.ndarray, aa: str, nt: str | None) -> tuple[str, str | None]:
    row = "".join([aa[k] if k >= 0 else "-" for k in places.tolist()])
    if nt is None:
        return row, None
    return row, "".join([c if k >= 0 and len(c := nt[3 * k : 3 * k + 3]) == 3 else "---" for k in places.tolist()])


def aligned_texts(reference: str, aa: str, nt: str | None) -> tuple[str, str | None]:
    """Peptide and codons in reference columns; a codon beyond the end of nt is a gap."""
    return _texts(align(reference, aa), aa, nt)


#: Groups into which the rows of one peptide are dealt; at most 64, the bits of a long.
DEALT = 64


def align_to_reference(records: DataFrame, reference: str, aa: str = "aa", nt: str | None = "nt", apart: tuple[str, ...] = ()) -> DataFrame:
    """records with aln_aa (as wide as the reference) and, if there are nucleotides, aln_nt (three times as wide).

    Peptides that are too long are left out. Each distinct pair of peptide and nucleotides is aligned once. apart: columns that tell records
    apart and are the same whenever the records are read; by them the records of a frequent pair are dealt over the join's tasks, else one gets them all."""
    reference = reference.upper()
    keys = [aa] if nt is None else [aa, nt]
    rows = records.where(F.length(aa) <= longest_query(len(reference)))

    def run(frames):
        profile = Profile(reference)
        for f in frames:
            found = align_all(profile, f[aa].tolist())
            got = [_texts(p, a, None if nt is None else n or "") for p, a, n in zip(found, f[aa], f[keys[-1]], strict=True)]
            yield pd.DataFrame({"_g": f._h, "_m": f._m, "_k0": f[aa], **({"_k1": f[nt]} if nt else {}), "aln_aa": [x for x, _ in got], **({"aln_nt": [y for _, y in got]} if nt else {})})

    rows = rows.withColumns({"_h": F.xxhash64(*keys), "_p": F.pmod(F.xxhash64(*apart), F.lit(DEALT)).cast("int") if apart else F.lit(0)})
    schema = "_g long, _m long, _k0 string, " + ("_k1 string, " if nt else "") + "aln_aa string" + (", aln_nt string" if nt else "")
    pairs = rows.groupBy("_h", *keys).agg(F.bit_or(F.expr("shiftleft(1L, _p)")).alias("_m"))  # the groups that a pair has
    done = pairs.mapInPandas(run, schema)
    done = done.withColumn("_q", F.explode(F.filter(F.sequence(F.lit(0), F.lit(DEALT - 1)), lambda k: F.getbit("_m", k) == 1)))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return rows.join(done, [F.col("_h") == F.col("_g"), F.col("_p") == F.col("_q"), *on]).drop("_h", "_p", "_g", "_q", "_m", "_k0", "_k1")
