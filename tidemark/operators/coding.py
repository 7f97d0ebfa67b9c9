"""Coding regions: best-frame translation of genes, and the reading frame segment of a genome that matches a reference.

Genes are translated by column expressions; what a later step uses more than once is made by a generator, which Catalyst neither merges nor evaluates again.
Genomes are searched in Arrow batches: a record's frames become numbers, each window of ten residues is one number, looked up in the reference's
sorted ones, so the cost doesn't grow with the reference or the number of segments. A null sequence has no coding region."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import sequences

LEAST_SCORE = 0.3
#: Longer than any sequence.
_REST = 2147483647


def stop_free(nt: Column, frame: int) -> Column:
    """The pieces between the stops of a frame, in order."""
    return F.split(sequences.translate(F.substring(nt, frame + 1, _REST)), r"\*", -1)


#: Digits of letters (4: no base), and residues of three such digits; a residue is a number of five bits.
_DIGIT = np.full(256, 4, np.uint8)
_DIGIT[[ord(c) for c in sequences.BASES]] = range(4)
_LETTERS = "ACDEFGHIKLMNPQRSTVWYX*"
_STOP = _LETTERS.index("*")
_RESIDUE = np.full(125, _LETTERS.index("X"), np.uint8)
for _k, _aa in enumerate(sequences.AMINO_ACIDS):
    _RESIDUE[25 * (_k // 16) + 5 * (_k // 4 % 4) + _k % 4] = _LETTERS.index(_aa)


def _windows(residues: np.ndarray) -> np.ndarray:
    """A number of fifty bits for each window of ten residues, by windows of two, four and eight."""
    one = residues.astype(np.int64)
    if len(one) < sequences.KMER:
        return one[:0]
    two = one[:-1] | one[1:] << 5
    four = two[:-2] | two[2:] << 10
    eight = four[:-4] | four[4:] << 20
    return eight[:-2] | two[8:] << 40


def _slots(windows: np.ndarray) -> np.ndarray:
    return (windows * np.int64(0x1E3779B97F4A7C15)) >> 46 & 0xFFFF


class Reference:
    """The k-mers of a reference, without those that hold an X; `known` has those that a segment can have."""

    def __init__(self, text: str):
        k = sequences.KMER
        each = {w for i in range(len(text) - k + 1) if "X" not in (w := text[i : i + k])}
        own = [[_LETTERS.index(c) for c in w] for w in each if set(w) <= set(_LETTERS[:20])]
        self.size, self.known = len(each), np.sort(_windows_of(own))
        self.taken = np.zeros(1 << 16, bool)
        self.taken[_slots(self.known)] = True

    def best(self, nt: str, least: int) -> tuple[int, int, str, float] | None:
        """Frame, place and peptide of the stop-free segment with the most of the reference's k-mers, and its share of them; ties to the first."""
        digits, best = _DIGIT[np.frombuffer(nt.encode("ascii", "replace"), np.uint8)], (0, 0, 0, None)
        for frame in range(3):
            m = (len(digits) - frame) // 3
            if m < max(least, sequences.KMER):
                continue
            codons = digits[frame : frame + 3 * m].reshape(m, 3)
            residues = _RESIDUE[codons[:, 0] * np.uint8(25) + codons[:, 1] * np.uint8(5) + codons[:, 2]]
            stops = np.flatnonzero(residues == _STOP)
            begins, ends = np.append(0, stops + 1), np.append(stops, m)
            windows = _windows(residues)
            hits = np.flatnonzero(self.taken[_slots(windows)])
            at = np.searchsorted(self.known, windows[hits])
            same = self.known[np.minimum(at, len(self.known) - 1)] == windows[hits]
            pairs = np.unique(np.searchsorted(stops, hits[same]) * len(self.known) + at[same])  # of segment and k-mer: each counts once
            counts = np.where(ends - begins >= least, np.bincount(pairs // len(self.known), minlength=len(begins)), 0)
            if counts.max() > best[0]:
                k = int(counts.argmax())
                best = (int(counts[k]), frame, int(frame + 3 * begins[k]), residues[begins[k] : ends[k]])
        n, frame, place, residues = best
        if not n or n / self.size < LEAST_SCORE:
            return None
        return frame, place, "".join(map(_LETTERS.__getitem__, residues.tolist())), n / self.size


def _windows_of(rows: list[list[int]]) -> np.ndarray:
    own = np.array(rows, np.int64).reshape(-1, sequences.KMER)
    return (own << (5 * np.arange(sequences.KMER))).sum(axis=1)


def extract_orfs(records: DataFrame, reference: str, least: int, seq: str = "seq") -> DataFrame:
    """records with nt, aa, frame and score of the stop-free segment of the three forward frames, `least` residues or longer, that covers
    most of the reference's k-mers; ties go to the first frame, then the first place.

    Records whose best segment scores below 0.3 are left out; so are all if the reference is shorter than a k-mer."""
    text = reference.upper()

    @F.pandas_udf("struct<frame int, place int, aa string, score double>")
    def found_in(nt: pd.Series) -> pd.DataFrame:
        known = Reference(text)
        found = [known.best(s, least) if s and len(known.known) else None for s in nt]
        return pd.DataFrame([f or (None, None, None, None) for f in found], columns=["frame", "place", "aa", "score"]).astype({"frame": "Int32", "place": "Int32", "score": "float64"})

    segment = found_in.asNondeterministic()  # so that no filter has it worked out twice
    rows = records.withColumn("_u", F.upper(F.col(seq))).withColumn("_b", segment("_u")).where("_b.aa is not null")
    out = rows.withColumns({"nt": F.substring(F.col("_u"), F.col("_b.place") + 1, 3 * F.length("_b.aa")), "aa": F.col("_b.aa"), "frame": F.col("_b.frame"), "score": F.col("_b.score")})
    return out.drop("_u", "_b")


def translate_cds(records: DataFrame, least: int, seq: str = "seq") -> DataFrame:
    """records with frame, nt and aa: the best frame, up to its first stop; peptides shorter than `least` are left out."""
    rows = records.withColumn("_u", F.upper(F.col(seq)))
    rows = rows.withColumn("frame", F.explode(F.array_compact(F.array(sequences.best_frame("_u")))))
    rows = rows.withColumn("aa", F.explode(F.array(F.substring_index(sequences.translate(F.substring(F.col("_u"), F.col("frame") + 1, F.lit(_REST))), "*", 1))))
    rows = rows.where(F.length("aa") >= least)
    return rows.withColumn("nt", F.substring(F.col("_u"), F.col("frame") + 1, 3 * F.length("aa"))).drop("_u")


def least_length(reference_aa: int, share: float = 0.5, given: int | None = None) -> int:
    return given if given is not None else max(1, int(share * reference_aa))
