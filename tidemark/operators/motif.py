"""Where a motif lies in an alignment, and its fragments.

Columns are found on the driver from one row or one consensus string; fragments are native column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import sequences

MOST_MISMATCH, LEAST_CALLED = 0.25, 0.9


def places_in_order(parts: list[str], s: str) -> list[int] | None:
    """Places of the parts' letters in s, each part as far left as can be behind the one before; None if one isn't there."""
    out, at = [], 0
    for p in parts:
        found = s.find(p, at)
        if found < 0:
            return None
        out += range(found, found + len(p))
        at = found + len(p)
    return out


def columns_of_row(row: str, parts: list[str]) -> list[int] | None:
    """Alignment columns of the parts in an aligned row that has gaps (-)."""
    filled = [k for k, c in enumerate(row) if c != "-"]
    found = places_in_order(parts, "".join(row[k] for k in filled))
    return None if found is None else [filled[k] for k in found]


def columns_in_reference(reference_row: str, parts: list[str]) -> list[int]:
    found = columns_of_row(reference_row, parts)
    if found is None:
        raise ValueError("a motif part isn't in the reference, or not in this order")
    return found


def columns_in_data(rows: DataFrame, parts: list[str], aln: str = "aln_aa", order: tuple[str, ...] = ("file_path", "ordinal")) -> list[int]:
    """By the first row, in file order, that has all parts."""
    first = rows.where(sequences.parts_in_order(parts, F.replace(F.upper(F.col(aln)), F.lit("-"), F.lit("")))).agg(F.min_by(F.upper(F.col(aln)), F.struct(*order)).alias("row")).first()
    if first.row is None:
        raise ValueError("no row has all motif parts")
    return columns_of_row(first.row, parts)


def _letters(text: str) -> np.ndarray:
    """A number for each column; -1 for gaps."""
    out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out[out == ord("-")] = -1
    return out


_BASE = np.full(256, 64, np.int64)
_BASE[[ord(c) for c in sequences.BASES]] = range(4)


def _codons(text: str) -> np.ndarray:
    """A number for each whole codon; -1 for those of other letters than A, C, G and T."""
    base = _BASE[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    base = base[: len(base) // 3 * 3].reshape(-1, 3)
    out = base[:, 0] * 16 + base[:, 1] * 4 + base[:, 2]
    out[(base == 64).any(axis=1)] = -1
    return out


def _codon(k: int) -> str:
    return "".join(sequences.BASES[k // d % 4] for d in (16, 4, 1))


def _count(numbers, name, order: list[str]):
    """Counts a task's columns by value, with the first place in order that each was seen at: one row a column and value, however many records."""

    def run(frames):
        found: dict = {}
        for f in frames:
            places = sorted(zip(*(f[c].tolist() for c in order), range(len(f)), strict=True))
            rows = [numbers(f.text.iloc[p[-1]]) for p in places]
            cells = np.concatenate([np.arange(len(r)) << 21 | r for r in rows if len(r)] or [np.zeros(0, np.int64)])
            of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[cells >= 0]
            keys, first, times = np.unique(cells[cells >= 0], return_index=True, return_counts=True)
            for key, at, n in zip(keys.tolist(), of[first].tolist(), times.tolist(), strict=True):
                before, o = found.get(key, (0, None))
                found[key] = (before + n, places[at][:-1] if o is None else min(o, places[at][:-1]))
        yield pd.DataFrame([(key >> 21, name(key & 0x1FFFFF), n, *o) for key, (n, o) in found.items()], columns=["pos", "value", "n", *order])

    return run


def modes(rows: DataFrame, aln: str, order: Column, coding: bool = False) -> DataFrame:
    """pos, value, n: the most frequent letter of each column that isn't a gap, or whole codon of A, C, G and T (ties: the value that comes first in order).

    Each task counts its own columns, so what is shuffled doesn't grow with the number of records."""
    given = rows.select(F.upper(F.col(aln)).alias("text"), order.alias("o")).where("text is not null")
    kind = given.schema["o"].dataType
    inner = [f"o.{f}" for f in kind.names] if hasattr(kind, "names") else ["o"]
    names = [f"o{k}" for k in range(len(inner))]
    flat = given.select("text", *(F.col(c).alias(x) for c, x in zip(inner, names, strict=True)))
    schema = "pos int, value string, n long, " + ", ".join(f"{x} {flat.schema[x].dataType.simpleString()}" for x in names)
    counted = flat.mapInPandas(_count(_codons if coding else _letters, _codon if coding else chr, names), schema)
    merged = counted.groupBy("pos", "value").agg(F.sum("n").alias("n"), F.min(F.struct(*names)).alias("o"))
    return merged.groupBy("pos").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "o")).alias("value"), F.max("n").alias("n"))


def consensus_rows(rows: DataFrame, aln: str, order: Column) -> DataFrame:
    return modes(rows, aln, order)


def codon_consensus_rows(rows: DataFrame, aln: str, order: Column) -> DataFrame:
    return modes(rows, aln, order, coding=True)


def consensus(rows: DataFrame, width: int, aln: str, order: Column, coding: bool = False) -> str:
    """One letter a column: - (or X for codons) where nothing counts. Only `width` rows come to the driver."""
    if coding:
        found = codon_consensus_rows(rows, aln, order).select("pos", sequences.residue(F.col("value")).alias("value"))
    else:
        found = consensus_rows(rows, aln, order)
    letters = {r.pos: r.value for r in found.select("pos", "value").collect()}
    return "".join(letters.get(k, "X" if coding else "-") for k in range(width))


def best_place(text: Column, part: str, start: int = 0) -> Column:
    """struct(mismatches, place) where the part fits best at or behind start (ties: the first place); null if the text is too short."""
    last = F.length(text) - len(part)
    tried = F.transform(F.sequence(F.lit(start), last), lambda k: F.struct(sequences.hamming(F.substring(text, k + 1, F.lit(len(part))), F.lit(part)).alias("mismatches"), k.alias("place")))
    return F.when(last >= start, F.array_min(tried))


def place_part(text: str, part: str, start: int) -> int:
    """The same for a consensus on the driver; an error beyond a quarter of the part."""
    places = range(start, len(text) - len(part) + 1)
    if not places:
        raise ValueError("the alignment is shorter than the motif part")
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4")
    own = np.frombuffer(part.encode("utf-32-le"), "<u4")
    off = (np.lib.stride_tricks.sliding_window_view(letters, len(part))[start:] != own).sum(1)
    if off.min() > int(MOST_MISMATCH * len(part)):
        raise ValueError(f"the motif part fits nowhere ({off.min()} of {len(part)} differ)")
    return start + int(off.argmin())


def columns_in_consensus(text: str, parts: list[str]) -> list[int]:
    out, at = [], 0
    for p in parts:
        at = place_part(text, p, at)
        out += range(at, at + len(p))
        at += len(p)
    return out


def pick(s: Column, columns: list[int], width: int = 1) -> Column:
    """The columns' letters (or codons) as one text; a run of neighbours is one substring."""
    runs: list[list[int]] = []
    for c in columns:
        if runs and c == runs[-1][-1] + 1:
            runs[-1].append(c)
        else:
            runs.append([c])
    return F.concat(*(F.substring(s, r[0] * width + 1, len(r) * width) for r in runs))


def judged(rows: DataFrame, columns: list[int], aln_aa: str = "aln_aa", aln_nt: str | None = None, least: float = LEAST_CALLED) -> DataFrame:
    """rows with aa and nt of the motif, and dropped: `ambiguous` if too few residues are called (neither - nor X; stops count as called), `nt`
    if the nucleotides don't reach over the last column or don't give a codon for each called residue, else null. nt loses its gaps."""
    n = len(columns)
    out = rows.withColumn("aa", pick(F.upper(F.col(aln_aa)), columns))
    bad = n - F.length(F.regexp_replace("aa", "[-X]", ""))
    low = (F.lit(n) - bad).cast("double") < F.lit(least) * F.lit(n)
    if aln_nt is None:
        return out.withColumns({"nt": F.lit(""), "dropped": F.when(low, "ambiguous")})
    short = (F.coalesce(F.length(aln_nt), F.lit(0)) < 3 * columns[-1] + 3) | (F.length("nt") < 3 * (F.lit(n) - bad))
    out = out.withColumn("nt", F.replace(pick(F.upper(F.col(aln_nt)), columns, 3), F.lit("-"), F.lit("")))
    return out.withColumn("dropped", F.when(low, "ambiguous").when(short, "nt"))


def judged_codons(rows: DataFrame, columns: list[int], aln_nt: str = "aln_nt", least: float = LEAST_CALLED) -> DataFrame:
    """The same from aligned nucleotides alone: a codon with a gap is -, and stops count as not called."""
    n = len(columns)
    picked = pick(F.upper(F.col(aln_nt)), columns, 3)
    aa = F.array_join(F.transform(sequences.codons(picked), lambda c: F.when(F.contains(c, F.lit("-")), "-").otherwise(sequences.residue(c))), "")
    out = rows.withColumn("aa", aa).withColumn("nt", F.replace(picked, F.lit("-"), F.lit("")))
    return out.withColumn("dropped", F.when(F.length(F.regexp_replace("aa", r"[-X*]", "")).cast("double") < F.lit(least) * F.lit(n), "ambiguous"))


def kept(rows: DataFrame) -> DataFrame:
    return rows.where("dropped is null").drop("dropped")


def extract(rows: DataFrame, columns: list[int], aln_aa: str = "aln_aa", aln_nt: str | None = None, least: float = LEAST_CALLED) -> DataFrame:
    """The rows that `judged` keeps."""
    return kept(judged(rows, columns, aln_aa, aln_nt, least))


def extract_codons(rows: DataFrame, columns: list[int], aln_nt: str = "aln_nt", least: float = LEAST_CALLED) -> DataFrame:
    return kept(judged_codons(rows, columns, aln_nt, least))


def codon_width(width: int) -> int:
    if width % 3:
        raise ValueError(f"an alignment {width} wide isn't one of codons")
    return width // 3
