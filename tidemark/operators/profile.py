"""What a sequence file holds: molecule, alignment, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the two detectors: letters, shares and sample size.
PROTEIN_ONLY, NUCLEOTIDES, ENGINE_SHARE = "EFILPQXZ*", "ACGTUN", 0.98
SCANNER_LETTERS, SCANNER_SHARE = "ACGTUNRYSWKMBDHV.?-", 0.95
SAMPLE, GENOME_FACTOR = 1000, 1.5


def upper_median(length: str) -> Column:
    """The middle value of a column, the upper of two. Counted by value, so partial results merge and take as much room as there are different values."""
    return F.expr(f"percentile_disc(0.5) within group (order by `{length}` desc)").cast("long")


def letters_of(s: Column, letters: str) -> Column:
    """How many characters of s are among the letters."""
    return F.length(s) - F.length(F.translate(s, letters, ""))


def facts(records: DataFrame, seq: str = "seq") -> DataFrame:
    """records with the numbers by which both detectors judge a sequence, in place of it; so no sequence is shuffled."""
    s = F.upper(F.col(seq))
    core = F.replace(s, F.lit("-"), F.lit(""))
    return records.withColumns({
        "_len": F.length(s), "_core": F.length(core), "_odd": letters_of(core, PROTEIN_ONLY) > 0, "_nt": letters_of(core, NUCLEOTIDES),
        "_scan": letters_of(s, SCANNER_LETTERS), "_dash": F.contains(s, F.lit("-")), "_gap": s.rlike("[-.]")}).drop(seq)


def engine_profile(sample: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """molecule, aligned, median_len and sampled per group, by the engine's rule: gaps don't count; one protein letter or less
    than 98 % nucleotide letters make a protein; a gap (-) and one length make an alignment. sample: sequences, or their `facts`."""
    rows = facts(sample, seq) if seq in sample.columns else sample
    found = rows.groupBy(*by).agg(
        F.bool_or("_odd").alias("odd"), F.sum("_nt").alias("nt"), F.sum("_core").alias("all"),
        (F.bool_or("_dash") & (F.min("_len") == F.max("_len"))).alias("aligned"),
        upper_median("_len").cast("int").alias("median_len"), F.count("*").alias("sampled"))
    protein = F.col("odd") | ((F.col("all") > 0) & (F.col("nt") < ENGINE_SHARE * F.col("all")))
    return found.select(*by, F.when(protein, "protein").otherwise("nucleotide").alias("molecule"), "aligned", "median_len", "sampled")


def scanner_profile(sample: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """molecule, state and median_length per group, by the scanner's rule: gaps count as nucleotide letters, of which 95 % are asked for."""
    rows = facts(sample, seq) if seq in sample.columns else sample
    found = rows.groupBy(*by).agg(
        F.sum("_scan").alias("nt"), F.sum("_len").alias("all"),
        (F.bool_or("_gap") & (F.min("_len") == F.max("_len"))).alias("aligned"), upper_median("_len").cast("int").alias("median_length"))
    nucleotide = (F.col("all") > 0) & (F.col("nt") >= SCANNER_SHARE * F.col("all"))
    return found.select(*by, F.when(nucleotide, "nucleotide").otherwise("protein").alias("molecule"), F.when(F.col("aligned"), "aligned").otherwise("raw").alias("state"), "median_length")


def is_genome(median_nt: int, reference_aa: int) -> bool:
    return median_nt / 3 > GENOME_FACTOR * reference_aa


def totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count("*").alias("files"), F.sum("n_records").alias("records"), F.sum("size_bytes").alias("bytes"))
