"""Counts of variants by calendar bin: long tables, wide tables at the end.

Long: nt, aa, year, month, n. Null years and months are unknown. Grouping is by all keys, so Spark combines before it
shuffles, and a dominant variant costs one row a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences
from tidemark.sources.tables import AA, NT, TOTAL

KEYS = ["nt", "aa"]


def count_variants(fragments: DataFrame, keys: list[str] = KEYS, weight: str | None = None) -> DataFrame:
    """keys, year, month, n."""
    n = F.count("*") if weight is None else F.sum(weight)
    return fragments.groupBy(*keys, "year", "month").agg(n.cast("long").alias("n"))


def with_peptide(records: DataFrame) -> DataFrame:
    """nt without gaps, and aa: what is there, else the translation of nt."""
    nt = sequences.degap("nt")
    return records.withColumn("nt", nt).withColumn("aa", F.coalesce(F.col("aa"), sequences.translate("nt")))


def year_range(counts: DataFrame, start: int | None = None, end: int | None = None) -> tuple[int, int]:
    """First and last year of the axis: as given, else as observed, else 2000."""
    if start is None or end is None:
        low, high = counts.agg(F.min("year"), F.max("year")).first()
        start = start if start is not None else low if low is not None else 2000
        end = end if end is not None else high if high is not None else start
    return start, end


def label(monthly: bool, start: int) -> Column:
    return dates.monthly_label("year", "month", start) if monthly else dates.yearly_label("year", start)


def to_wide(counts: DataFrame, labels: list[str], bin_: Column, keys: list[str] = KEYS, total: str = TOTAL) -> DataFrame:
    """One column per label of the axis (0 where nothing was counted), and their sum. The labels are given, so no job looks for them."""
    placed = counts.groupBy(*keys, bin_.alias("bin")).agg(F.sum("n").alias("n"))
    wide = placed.groupBy(*keys).pivot("bin", labels).agg(F.sum("n")).na.fill(0, labels)
    return wide.withColumn(total, sum((F.col(f"`{x}`") for x in labels), F.lit(0).cast("long")))


def wide_counts(counts: DataFrame, monthly: bool = False, start: int | None = None, end: int | None = None, keys: list[str] = KEYS, total: str = TOTAL) -> DataFrame:
    """A calendar table: yearly `before S`, S.., `unknown`; monthly twelve months and Y-unknown a year, `unknown`.

    Records before a monthly axis are counted as unknown."""
    start, end = year_range(counts, start, end)
    return to_wide(counts, dates.calendar(start, end, monthly), label(monthly, start), keys, total)


def most_counted(wide: DataFrame, total: str = TOTAL, keys: list[str] = KEYS) -> DataFrame:
    return wide.orderBy(F.desc(total), *keys)


def top_variants(counts: DataFrame, n: int, keys: list[str] = KEYS) -> DataFrame:
    """The n most counted variants, ties by key."""
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), *keys).limit(n)


def integrate(tables: list[DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """The sum of long tables; labels are made afterwards, so different first years never mix."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.groupBy(*keys, "year", "month").agg(F.sum("n").cast("long").alias("n"))


def from_wide(wide: DataFrame, keys: list[str], skip: tuple[str, ...] = (TOTAL,)) -> DataFrame:
    """keys, bin, n of a wide table: the total is no bin; text that is no number and zero counts are left out."""
    bins = [c for c in wide.columns if c not in keys and c not in skip]
    number = {c: F.col(f"`{c}`").cast("string").try_cast("double").cast("long") for c in bins}
    long = wide.withColumns(number).unpivot(keys, [F.col(f"`{c}`") for c in bins], "bin", "n")
    return long.where(F.col("n") != 0)


def merge_bins(long: DataFrame, keys: list[str], monthly: bool, min_year: int, max_year: int | None = None) -> DataFrame:
    """The sum by keys and bin; implausible bins are `unknown`; an empty peptide (last key) is left out."""
    bin_ = F.when(dates.label_valid("bin", monthly, min_year, max_year), F.col("bin")).otherwise("unknown")
    return long.where(F.col(keys[-1]) != "").groupBy(*keys, bin_.alias("bin")).agg(F.sum("n").cast("long").alias("n"))


def called(rows: DataFrame, peptide: str = "aa", most: float = 0.10) -> DataFrame:
    """Rows whose peptide has at most this share of gaps and X."""
    return rows.where(sequences.gap_share(peptide) <= most)


def training_rows(merged: DataFrame, peptide: str = "aa", keys: list[str] = KEYS) -> DataFrame:
    """Rows for training: well-called variants, most counted first by order column `total`."""
    kept = called(merged, peptide)
    return kept.join(kept.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def audit(merged: DataFrame, group: list[str], peptide: str = "aa") -> DataFrame:
    """Per group: variants and counts kept and dropped by the gap filter, first and last kept bin, unknown counts (kept, all)."""
    keep = sequences.gap_share(peptide) <= 0.10
    known = F.col("bin") != "unknown"
    return merged.groupBy(*group).agg(
        F.count_distinct(F.when(keep, F.struct(*KEYS))).alias("variants_kept"),
        F.count_distinct(F.when(~keep, F.struct(*KEYS))).alias("variants_dropped"),
        F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0)).alias("counts_kept"),
        F.coalesce(F.sum(F.when(~keep, F.col("n"))), F.lit(0)).alias("counts_dropped"),
        F.min(F.when(keep & known, F.col("bin"))).alias("first_bin"),
        F.max(F.when(keep & known, F.col("bin"))).alias("last_bin"),
        F.coalesce(F.sum(F.when(keep & ~known, F.col("n"))), F.lit(0)).alias("unknown_kept"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown_all"),
    )


def fan_out(rows: DataFrame, benchmarks: DataFrame, on: list[str]) -> DataFrame:
    """A row per benchmark that a group and motif serve. benchmarks: on columns and an array `benchmarks`."""
    each = benchmarks.select(*on, F.explode("benchmarks").alias("benchmark"))
    return rows.join(each, on)


def with_total(summary: DataFrame, name: str) -> DataFrame:
    """The rows of a summary and one that sums its numbers, called TOTAL."""
    numbers = [c for c, t in summary.dtypes if c != name and t in ("bigint", "int", "double", "float", "smallint")]
    total = summary.agg(*(F.sum(c).alias(c) for c in numbers)).withColumn(name, F.lit("TOTAL"))
    return summary.unionByName(total, allowMissingColumns=True)


def rename_keys(wide: DataFrame) -> DataFrame:
    return wide.withColumnsRenamed({"nt": NT, "aa": AA})
