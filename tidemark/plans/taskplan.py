"""The task plan: which groups of benchmarks are counted from which files, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.plans import grouping, routing
from tidemark.sources import files


def config_text(groups: DataFrame) -> Column:
    """A group's configuration: its reference and its motifs."""
    each = F.transform("motifs", lambda m: F.concat(F.lit(">motif_reference_"), m.tag, F.lit("\n"), m.motif, F.lit("\n")))
    return F.concat(F.lit(">protein_reference\n"), "reference", F.lit("\n"), F.array_join(each, ""))


def write_configs(spark: SparkSession, planned: DataFrame, folder: str) -> None:
    """One file per planned group, of which a registry has some dozens."""
    for r in planned.select("group_id", config_text(planned).alias("text")).toLocalIterator():
        files.write_text(spark, f"{folder}/{r.group_id}.txt", r.text)


def decide(registry: DataFrame, inventory: DataFrame, full: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(planned groups with tier, files and rejected files; skipped; blocked; routed pairs). full: benchmark_file and full_protein of references kept as files."""
    rows = grouping.usable(registry, full)
    blocked = rows.where("blocked = 'no full protein'").select("benchmark_file", F.lit("needs the full-length parent protein").alias("reason"))
    empty = rows.where("blocked = 'empty target'").select("benchmark_file", F.lit("empty target_seq").alias("reason"))
    groups = grouping.groups(rows)
    routed = routing.route(groups, inventory)
    good = F.col("mode").isNotNull()
    served = routed.groupBy("group_id").agg(
        F.first("tier").alias("fasta_tier"),
        F.array_sort(F.collect_list(F.when(good, F.struct("path", "rel_path", "mode", "state", "n_records")))).alias("fasta_files"),
        F.array_sort(F.collect_list(F.when(~good, F.struct(F.col("rel_path").alias("file"), "reason")))).alias("rejected_files"))
    both = groups.join(served, "group_id", "left")
    tiers = F.array_join(routing.folder_tiers(F.col("virus_code"), F.col("host"), F.col("segment")), ", ")
    why = F.when(F.col("fasta_tier").isNull(), F.concat(F.lit("no FASTA folder matched (tried: "), tiers, F.lit(")"))).when(
        F.size("fasta_files") == 0, F.concat(F.lit("folder '"), "fasta_tier", F.lit("' has no suitable file for a "), F.col("ref_len").cast("string"), F.lit(" aa reference")))
    none = both.where(why.isNotNull()).select(F.explode("benchmarks").alias("benchmark_file"), why.alias("reason"))
    return both.where(F.size("fasta_files") > 0), empty.unionByName(none), blocked, routed


def document(planned: DataFrame, skipped: DataFrame, blocked: DataFrame, on_disk: DataFrame, registry: str, inventory: str, config_dir: str) -> DataFrame:
    """The plan as one row; of the columns of `tables.PLAN`. on_disk: benchmark_file."""
    motifs = F.transform("motifs", lambda m: F.struct(m.tag.alias("tag"), m.len.alias("len"), m.benchmarks.alias("benchmarks")))
    config = F.concat(F.lit(config_dir.rstrip("/") + "/"), "group_id", F.lit(".txt"))
    group = F.struct(
        "group_id", "virus_code", "host", "binning", "reference_mode", "ref_len", config.alias("config"), motifs.alias("motifs"), "benchmarks", "fasta_tier", "fasta_files", "rejected_files")

    def listed(df: DataFrame, entry: Column, name: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(entry)).alias(name))

    missing = planned.select(F.explode("benchmarks").alias("benchmark_file")).distinct().join(on_disk, "benchmark_file", "left_anti")
    pair = F.struct("benchmark_file", "reason")
    parts = [listed(planned, group, "groups"), listed(skipped, pair, "skipped"), listed(blocked, pair, "blocked"), listed(missing, F.col("benchmark_file"), "dms_missing_on_disk")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # of one row each
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return out.select(when.alias("created_at"), F.lit(registry).alias("registry"), F.lit(inventory).alias("inventory"), "groups", "skipped", "blocked", "dms_missing_on_disk")


def pending(plan: DataFrame) -> DataFrame:
    """group_id, chunk (of the whole relative path), path, rel_path of each planned file. plan: groups as of `tables.read_plan`."""
    f = plan.select("group_id", "virus_code", "binning", "config", F.explode("fasta_files").alias("f"))
    return f.select("group_id", "virus_code", "binning", "config", texts.chunk_name("f.rel_path").alias("chunk"), "f.path", "f.rel_path")
