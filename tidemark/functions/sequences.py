"""Sequence functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code, codons in the order T, C, A, G of each base.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
KMER, FRAME_TEST = 10, 1200


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Residue by a codon's three digits read as a number: 0 to 3 for the bases in their order, 4 for any other letter.
_RESIDUES = ["X"] * 445
for _k, _aa in enumerate(AMINO_ACIDS):
    _RESIDUES[100 * (_k // 16) + 10 * (_k // 4 % 4) + _k % 4] = _aa


def _digits(nt: Column) -> Column:
    return F.translate(F.regexp_replace(nt, f"(?s)[^{BASES}]", "4"), BASES, "0123")


def _residue(digits: Column) -> Column:
    return F.get(F.lit(_RESIDUES), digits.cast("int"))


def residue(codon: Column) -> Column:
    """The amino acid of an upper-case codon of three letters; X if a base isn't A, C, G or T."""
    return _residue(_digits(codon))


def codons(nt) -> Column:
    """The whole codons of a sequence, upper case."""
    return F.regexp_extract_all(F.upper(_col(nt)), F.lit("(?s).{3}"), 0)


def translate(nt) -> Column:
    """Peptide of the first frame: an unfinished codon is left out, stops are *, any codon with another base (U too) is X."""
    return F.array_join(F.transform(F.regexp_extract_all(_digits(F.upper(_col(nt))), F.lit("(?s).{3}"), 0), _residue), "")


def stops(aa: Column) -> Column:
    return F.length(aa) - F.length(F.replace(aa, F.lit("*"), F.lit("")))


def longest_segment(aa: Column) -> Column:
    """Length of the longest piece without a stop."""
    return F.array_max(F.transform(F.split(aa, r"\*", -1), F.length))


def best_frame(nt, test: int = FRAME_TEST) -> Column:
    """Frame 0, 1 or 2 with the fewest stops in the first `test` bases; ties: longest piece, then lowest frame. Null below 3 bases."""
    head = F.substring(_col(nt), 1, test)
    peptides = F.array(*(translate(F.substring(head, frame + 1, test)) for frame in range(3)))
    rated = F.transform(peptides, lambda aa, frame: F.struct(stops(aa).alias("stops"), (-longest_segment(aa)).alias("longest"), frame.alias("frame")))
    whole = F.greatest(F.lit(0), F.least(F.lit(3), F.length(head) - 2))  # frames with a whole codon
    return F.array_min(F.slice(rated, F.lit(1), whole)).frame


def longest_orf(aa) -> Column:
    """struct(seq, start, end) of the first longest piece without a stop."""
    step = F.aggregate(
        F.split(_col(aa), r"\*", -1),
        F.struct(F.lit("").alias("seq"), F.lit(0).alias("start"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(F.length(s) > F.length(acc.seq), s).otherwise(acc.seq).alias("seq"),
            F.when(F.length(s) > F.length(acc.seq), acc["at"]).otherwise(acc.start).alias("start"),
            (acc["at"] + F.length(s) + 1).alias("at"),
        ),
    )
    return F.when(F.length(step.seq) > 0, F.struct(step.seq.alias("seq"), step.start.alias("start"), (step.start + F.length(step.seq)).alias("end")))


def letters(s) -> Column:
    return F.regexp_extract_all(_col(s), F.lit("(?s)."), 0)


def hamming(a, b) -> Column:
    """Places at which two strings differ, up to the end of the shorter."""
    return F.size(F.filter(F.zip_with(letters(a), letters(b), lambda x, y: x != y), lambda d: d))


def degap(s, upper: bool = True) -> Column:
    """Without gaps (- and .) and blanks; upper case unless told otherwise."""
    out = F.trim(F.translate(_col(s), "-. ", ""))
    return F.upper(out) if upper else out


def reference_hash(s) -> Column:
    return F.substring(F.sha1(_col(s).cast("binary")), 1, 8)


def kmers(s, k: int = KMER) -> Column:
    """The distinct k-mers without an X."""
    s = _col(s)
    found = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))"), 1)
    return F.array_distinct(F.filter(found, lambda x: ~F.contains(x, F.lit("X"))))


def kmer_coverage(s, reference, k: int = KMER) -> Column:
    """Share of the reference's k-mers that s has; 0 if the reference has none."""
    ref = kmers(reference, k)
    return F.when(F.size(ref) > 0, F.size(F.array_intersect(kmers(s, k), ref)) / F.size(ref)).otherwise(0.0)


def gap_share(aa) -> Column:
    """Share of - and X; 1 for an empty peptide."""
    aa = _col(aa)
    return F.when(F.length(aa) == 0, 1.0).otherwise(F.length(F.regexp_replace(aa, "[^-X]", "")) / F.length(aa))


def parts_in_order(parts: list[str], s) -> Column:
    """Whether all parts occur in s one after the other, not overlapping, each as far left as can be."""
    s = _col(s)
    state = F.struct(F.lit(0).alias("at"), F.lit(True).alias("ok"))
    for p in parts:
        tail = F.substring(s, state["at"] + 1, F.length(s))
        where = F.instr(tail, F.lit(p))
        state = F.struct((state["at"] + where - 1 + len(p)).alias("at"), (state.ok & (where > 0)).alias("ok"))
    return state.ok
