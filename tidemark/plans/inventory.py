"""Scan of a folder of FASTA files: one profiled row per file, and the inventory document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.sources import fasta, files


def scan(spark: SparkSession, root: str, sample: int = profile.SAMPLE) -> DataFrame:
    """path, rel_path, folder, molecule, state, median_length, n_records, size_bytes of the FASTA files under root, in order of path.

    The profile is that of a file's first `sample` records; of a file without records it is unknown. An error if there is no file."""
    listed = fasta.list_files(spark, root)
    if listed.isEmpty():
        raise ValueError(f"no FASTA files under {root}")
    top = files.qualified(spark, root).rstrip("/") + "/"
    records = fasta.read_fasta(spark, root, recursive=True, encoding="UTF-8")
    known = profile.facts(records.select(fasta.whole().alias("file_path"), F.col("file_path").alias("part"), "number", "ordinal", "seq"))
    profiles = profile.scanner_profile(fasta.first_records(known, sample, order=["part", "ordinal"]), ["file_path"])
    counted = fasta.count_records(records)
    rows = listed.join(profiles, listed.path == profiles.file_path, "left").drop("file_path").join(counted, listed.path == counted.file_path, "left")
    rel = F.substring(F.col("path"), F.lit(len(top) + 1), F.length("path"))
    folder = F.when(F.contains(rel, F.lit("/")), F.regexp_replace(rel, r"/[^/]*$", "")).otherwise("")
    return rows.select(
        "path", rel.alias("rel_path"), folder.alias("folder"), F.coalesce("molecule", F.lit("unknown")).alias("molecule"), F.coalesce("state", F.lit("unknown")).alias("state"),
        F.coalesce("median_length", F.lit(0)).cast("long").alias("median_length"), F.coalesce("n_records", F.lit(0).cast("long")).alias("n_records"), "size_bytes").orderBy("path")


def document(inventory: DataFrame, root: str, sample: int = profile.SAMPLE) -> DataFrame:
    """The inventory as one row."""
    entries = F.array_sort(F.collect_list(F.struct(*inventory.columns)))
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return inventory.agg(entries.alias("files")).select(F.lit(root).alias("fasta_root"), when.alias("scanned_at"), F.lit(sample).alias("sample_size"), "files")
