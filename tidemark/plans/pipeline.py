"""The engine: from FASTA records to variant counts, by what the input and the configuration hold."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences
from tidemark.operators import align, coding, counts, motif, profile
from tidemark.sources import fasta
from tidemark.sources.config import Config

ORDER = ("file_path", "ordinal")


@dataclass
class Facts:
    molecule: str
    aligned: bool
    median_len: int
    sampled: int


def detect(records: DataFrame, sample: int = profile.SAMPLE) -> Facts:
    """By the first records in file order, of which only lengths and letter counts are sorted; one row comes to the driver."""
    few = records.where(F.col("number") <= sample) if "number" in records.columns else records
    head = profile.facts(few.select(*ORDER, "seq")).orderBy(*ORDER).limit(sample).withColumn("_one", F.lit(1))
    row = profile.engine_profile(head, ["_one"]).first()
    if row is None:
        raise ValueError("no sequences")
    return Facts(row.molecule, row.aligned, row.median_len, row.sampled)


def dated(records: DataFrame) -> DataFrame:
    return records.withColumn("_d", dates.parse_date("description")).withColumns({"year": F.col("_d.year"), "month": F.col("_d.month")}).drop("_d")


def place(m, reference: str, rows: DataFrame, consensus, aln: str = "aln_aa") -> list[int]:
    """Columns of a motif: by the reference, else the first row with all parts, else the consensus (a function that gives its text)."""
    found = motif.columns_of_row(reference, m.parts) if reference else None
    if found is None:
        try:
            found = motif.columns_in_data(rows, m.parts, aln, ORDER)
        except ValueError:
            found = motif.columns_in_consensus(consensus(), m.parts)
    return found


def _placed_by_reference(reference: str, config: Config, rows: DataFrame, width: int, aln: str):
    text = functools.cache(lambda: motif.consensus(rows, width, aln, F.struct(*ORDER)))
    for m in config.motifs:
        yield m, place(m, reference, rows, text, aln)


def _by_motif(rows: DataFrame, placed, aln_nt: str | None, least: float) -> DataFrame:
    out = None
    for m, columns in placed:
        one = motif.extract(rows, columns, "aln_aa", aln_nt, least).withColumn("motif_tag", F.lit(m.tag))
        out = one if out is None else out.unionByName(one)
    return out


def fragments(records: DataFrame, config: Config, facts: Facts, least_called: float = motif.LEAST_CALLED, orf_share: float = 0.5, orf_least: int | None = None) -> DataFrame:
    """nt, aa, year, month and motif_tag of each record (and motif) that passes."""
    rows, ref = dated(records), config.protein
    nucleotide = facts.molecule == "nucleotide"
    if facts.aligned and nucleotide:
        if config.motifs:
            width = motif.codon_width(facts.median_len)
            text = motif.consensus(rows, width, "seq", F.struct(*ORDER), coding=True)
            out = None
            for m in config.motifs:
                one = motif.extract_codons(rows, motif.columns_in_consensus(text, m.parts), "seq", least_called).withColumn("motif_tag", F.lit(m.tag))
                out = one if out is None else out.unionByName(one)
        else:
            out = counts.with_peptide(rows.withColumns({"nt": F.col("seq"), "aa": F.lit(None).cast("string")})).withColumn("motif_tag", F.lit("whole"))
        return out.select("nt", "aa", "year", "month", "motif_tag")
    if facts.aligned:
        rows = rows.withColumns({"aln_aa": F.col("seq"), "nt": F.lit("")})
        if config.motifs:
            out = _by_motif(rows, _placed_by_reference("", config, rows, facts.median_len, "aln_aa"), None, least_called)
        else:
            out = rows.withColumns({"aa": F.col("aln_aa"), "motif_tag": F.lit("whole")})
        return out.select("nt", "aa", "year", "month", "motif_tag")
    if ref is None:
        raise ValueError("raw sequences need a protein reference")
    if nucleotide:
        least = coding.least_length(len(ref), orf_share, orf_least)
        genome = profile.is_genome(facts.median_len, len(ref))
        rows = coding.extract_orfs(rows, ref, least) if genome else coding.translate_cds(rows, least)
        rows = align.align_to_reference(rows, ref, apart=ORDER)
    else:
        rows = align.align_to_reference(rows.withColumn("aa", F.col("seq")), ref, nt=None, apart=ORDER)
    aln_nt = "aln_nt" if nucleotide else None
    if config.motifs:
        out = _by_motif(rows, _placed_by_reference(ref, config, rows, len(ref), "aln_aa"), aln_nt, least_called)
    else:
        nt = sequences.degap("aln_nt") if nucleotide else F.lit("")
        out = rows.withColumns({"aa": F.col("aln_aa"), "nt": nt, "motif_tag": F.lit("whole")})
    return out.select("nt", "aa", "year", "month", "motif_tag")


def run(spark: SparkSession, path: str, config: Config, **options) -> DataFrame:
    """Long counts of one FASTA file: motif_tag, nt, aa, year, month, n. Folders of files, with their tables and summaries, are `runs.run`'s."""
    records = fasta.read_fasta(spark, path)
    return counts.count_variants(fragments(records, config, detect(records), **options), ["motif_tag", "nt", "aa"])
