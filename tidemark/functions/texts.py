"""Names, numbers and segment hints in registry and file texts, as native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a protein field that tell an influenza segment, tried in this order.
SEGMENT_WORDS = [
    ("PB2", ["PB2"]),
    ("PB1", ["PB1"]),
    ("PA", ["PA polymerase", "PA subunit"]),
    ("HA", ["hemagglutinin", "HA "]),
    ("NA", ["neuraminidase", "NA "]),
    ("NP", ["nucleoprotein", "NP "]),
]
#: Patterns of file names that tell a segment, tried in this order.
FILE_HINTS = [
    ("PB2", "PB2"),
    ("PB1", "PB1"),
    ("PA", r"(?:^|[_\-])PA(?:[_\-]|$)"),
    ("NP", r"(?:^|[_\-])NP(?:[_\-]|$)|NUCLEOP"),
    ("HA", r"(?:^|[_\-])H\d+|HEMAG|(?:^|[_\-])HA(?:[_\-]|$)"),
    ("NA", r"(?:^|[_\-])N\d+|NEURAM|(?:^|[_\-])NA(?:[_\-]|$)"),
]


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _first(cases) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def segment_of_protein(text, whole_words: bool = True) -> Column:
    """Segment that a protein description names, or null. whole_words: `RNA polymerase` doesn't name NA."""
    low = F.lower(F.coalesce(_col(text), F.lit("")))

    def has(word: str) -> Column:
        w = word.lower()
        return low.rlike(rf"(?<![a-z0-9]){re.escape(w.strip())}" + (r"\s" if w.endswith(" ") else "")) if whole_words else F.contains(low, F.lit(w))

    return _first((has(w), seg) for seg, words in SEGMENT_WORDS for w in words)


def segment_of_file(path, strip_extension: bool = True) -> Column:
    """Segment that a file's name hints at, or null. strip_extension: `x_PA.fasta` hints at PA."""
    base = F.substring_index(F.replace(_col(path), F.lit("\\"), F.lit("/")), "/", -1)
    if strip_extension:
        base = F.regexp_replace(base, r"\.[^.]*$", "")
    return _first((base.rlike(f"(?i){p}"), seg) for seg, p in FILE_HINTS)


def safe_tag(tag) -> Column:
    return F.regexp_replace(_col(tag), r"[^A-Za-z0-9_\-]", "_")


def file_stem(path) -> Column:
    """Name without folder and last extension."""
    return F.regexp_replace(F.substring_index(_col(path), "/", -1), r"(?<=.)\.[^.]*$", "")


def chunk_name(rel_path) -> Column:
    """The stem, and a digest of the whole path, so that files of one name in two folders, or with two extensions, are two chunks."""
    return F.concat(file_stem(rel_path), F.lit("-"), F.substring(F.sha1(_col(rel_path).cast("binary")), 1, 8))


def benchmark_stem(name) -> Column:
    return F.regexp_replace(_col(name), r"(?i)\.csv$", "")


def whole_number(text) -> Column:
    """Number written as text, cut to an integer; null if it isn't one."""
    return F.expr(f"cast(try_cast(`{text}` as double) as bigint)") if isinstance(text, str) else text.try_cast("double").cast("long")


def job_name(group, stem, most: int = 200) -> Column:
    return F.substring(F.concat(F.lit("tm_"), _col(group), F.lit("_"), _col(stem)), 1, most)


def annotation(kind: str, residues: Column, frame: Column, score: Column | None = None) -> Column:
    """Note for a header; the thousands separator keeps a length from looking like a year."""
    parts = [F.lit(f"[{kind}_aa="), F.format_number(residues, 0), F.lit("] [frame +"), (frame + 1).cast("string"), F.lit("]")]
    return F.concat(*parts, *([F.lit(" [kmer_score="), F.format_string("%.2f", score), F.lit("]")] if score is not None else []))
