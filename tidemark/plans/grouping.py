"""Registry rows that share a reference share one alignment; equal motifs are counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import sequences, texts


def usable(registry: DataFrame, full: DataFrame | None = None) -> DataFrame:
    """One row per benchmark (the first) with target, mode and reference; `blocked` tells why a row can't be planned.

    full: benchmark_file and full_protein, for rows whose full protein isn't in the registry."""
    if full is not None:
        registry = registry.join(full, "benchmark_file", "left").withColumn("full_protein_seq", F.coalesce(F.nullif(F.trim("full_protein_seq"), F.lit("")), "full_protein")).drop("full_protein")
    registry = registry.where(F.trim(F.coalesce("benchmark_file", F.lit(""))) != "")
    first = registry.groupBy("benchmark_file").agg(F.min_by(F.struct(*[c for c in registry.columns if c != "benchmark_file"]), "ordinal").alias("r")).select("benchmark_file", "r.*")
    target, full = sequences.degap(F.coalesce("target_seq", F.lit(""))), sequences.degap(F.coalesce("full_protein_seq", F.lit("")))
    mode = F.coalesce(F.nullif(F.trim("recommended_reference"), F.lit("")), F.lit("target_as_reference"))
    rows = first.withColumns({"target": target, "mode": mode}).withColumn("reference", F.when(F.col("mode") == "full_protein_plus_motif", F.nullif(full, F.lit(""))).otherwise(F.col("target")))
    return rows.withColumn("blocked", F.when(F.col("target") == "", "empty target").when(F.col("reference").isNull(), "no full protein"))


def motifs(rows: DataFrame) -> DataFrame:
    """Per reference and motif: tag, length, benchmarks. The tag is `whole` for the reference itself, else the first benchmark's name."""
    keyed = rows.where("blocked is null").withColumns({"ref_hash": sequences.reference_hash("reference"), "motif_hash": sequences.reference_hash("target")})
    found = keyed.groupBy("ref_hash", "motif_hash").agg(
        F.min("ordinal").alias("ordinal"), F.min_by("benchmark_file", "ordinal").alias("first"), F.first("target").alias("motif"),
        F.bool_or(F.col("target") == F.col("reference")).alias("whole"), F.array_sort(F.collect_set("benchmark_file")).alias("benchmarks"))
    tag = F.when(F.col("whole"), "whole").otherwise(texts.safe_tag(texts.benchmark_stem("first")))
    return found.select("ref_hash", "ordinal", tag.alias("tag"), F.length("motif").alias("len"), "motif", "benchmarks")


def groups(rows: DataFrame) -> DataFrame:
    """Per reference: group_id, attributes of its first row, motifs, benchmarks."""
    keyed = rows.where("blocked is null").withColumn("ref_hash", sequences.reference_hash("reference"))
    head = keyed.groupBy("ref_hash").agg(F.min_by(F.struct("virus_code", "host", "protein", "mode", "reference", "uniprot_full_len"), "ordinal").alias("r"), F.array_sort(F.collect_set("benchmark_file")).alias("benchmarks")).select("ref_hash", "r.*", "benchmarks")
    inner = motifs(rows).groupBy("ref_hash").agg(F.array_sort(F.collect_list(F.struct("ordinal", "tag", "len", "motif", "benchmarks"))).alias("motifs"))
    out = head.join(inner, "ref_hash")
    length = F.length("reference")
    return out.select(
        F.concat_ws("_", "virus_code", F.concat(length.cast("string"), F.lit("aa")), "ref_hash").alias("group_id"), "ref_hash", "virus_code", "host",
        F.when(F.col("virus_code") == "SCV2", "monthly").otherwise("yearly").alias("binning"), F.col("mode").alias("reference_mode"), length.alias("ref_len"),
        "reference", texts.segment_of_protein("protein").alias("segment"), F.col("uniprot_full_len").try_cast("double").cast("int").alias("parent_len"), "motifs", "benchmarks")
