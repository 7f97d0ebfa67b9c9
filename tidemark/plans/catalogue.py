"""What is aligned and counted already: probes of chunk folders, manifests, registration, the catalogue document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import sequences
from tidemark.sources import config, files, tables

#: Fixed names of the marker, the manifest and the tables by which a chunk is judged.
MARKER, MANIFEST = ".msa_complete", "alignment_manifest.json"
ALIGNED = r"_aligned_proteins?\.fasta(/|$)"
COUNTS = r"_counts_by_(?:month|year)_wide\.csv(/|$)"


def probe(listed: DataFrame) -> DataFrame:
    """folder, chunk, msa_complete, aligned_proteins, counts_by_motif (tag: path), reusable of each chunk. listed: path below the folder of alignments (folder/chunk/...).

    Files may lie any level deeper. The tag is what stands between the chunk's name and the fixed ending, so it may hold underscores; without one it is `motif`."""
    parts = F.split("path", "/")
    rows = listed.where(F.size(parts) >= 3).select(F.get(parts, F.lit(0)).alias("folder"), F.get(parts, F.lit(1)).alias("chunk"), "path")
    name = F.regexp_replace(F.regexp_extract("path", rf"([^/]*){COUNTS}", 1), r"^/", "")
    own = F.startswith(name, F.col("chunk"))
    tag = F.when(own, F.regexp_replace(F.substring(name, F.length("chunk") + 1, F.length("path")), "^_", "")).otherwise(F.regexp_extract(name, r"_([^_]*)$", 1))
    counted = F.col("path").rlike(COUNTS)
    entry = F.when(counted, F.struct(F.when(tag == "", "motif").otherwise(tag).alias("key"), F.regexp_replace("path", rf"({COUNTS}).*$", "$1").alias("value")))
    found = rows.groupBy("folder", "chunk").agg(
        F.bool_or(F.endswith(F.col("path"), F.lit("/" + MARKER))).alias("msa_complete"), F.bool_or(F.col("path").rlike(ALIGNED)).alias("aligned_proteins"),
        F.collect_set(entry).alias("c"))
    last = F.transform(F.array_distinct(F.transform("c", lambda e: e.key)), lambda k: F.struct(k.alias("key"), F.array_max(F.transform(F.filter("c", lambda e: e.key == k), lambda e: e.value)).alias("value")))
    return found.select("folder", "chunk", "msa_complete", "aligned_proteins", F.map_from_entries(last).alias("counts_by_motif"), (F.col("msa_complete") & F.col("aligned_proteins")).alias("reusable"))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Files below a folder of alignments; folders and chunks that are still being made, or being replaced, are none."""
    found = [(p, n) for p, n in files.walk(spark, root) if not any(x.startswith("_") for x in p.split("/")[:2])]
    return spark.createDataFrame(found, "path string, size_bytes long")


def manifest(group_id: Column, ref_hash: Column, ref_len: Column, config_path: Column, motif_tags: Column, source: Column) -> Column:
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return F.struct(group_id.alias("group_id"), ref_hash.alias("ref_hash"), ref_len.cast("int").alias("ref_len"), config_path.alias("config"), motif_tags.alias("motif_tags"), when.alias("registered_at"), source.alias("source_folder_name"))


def write_manifests(spark: SparkSession, planned: DataFrame, root: str) -> None:
    """One manifest per planned group (columns of `tables.read_plan`)."""
    rows = planned.select("group_id", F.to_json(manifest(F.col("group_id"), F.substring_index("group_id", "_", -1), F.col("ref_len"), F.col("config"), F.col("motifs.tag"), F.lit("tidemark"))).alias("text"))
    for r in rows.toLocalIterator():
        files.write_text(spark, f"{root}/{r.group_id}/{MANIFEST}", r.text + "\n")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """folder and the manifest's fields (null where the document can't be read) of the folders that have one."""
    paths = [f"{root}/{name}/{MANIFEST}" for name in files.folders(spark, root) if files.exists(spark, f"{root}/{name}/{MANIFEST}")]
    if not paths:
        return spark.createDataFrame([], f"folder string, {tables.MANIFEST}")
    raw = spark.read.text(paths, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)/[^/]*$", 1).alias("folder"), F.from_json("value", tables.MANIFEST, {"mode": "PERMISSIVE"}).alias("m"))
    return raw.select("folder", "m.*")


def register(registry: DataFrame, protein: str, motifs: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(group_id, ref_hash and ref_len of a reference; motif tag and benchmark of each exact match). The virus code is that of the last row whose target is the reference, else UNK.

    registry: benchmark_file, virus_code, target_seq, ordinal. The configuration's few texts are literals of the plan."""
    if not protein:
        raise ValueError("the configuration has no protein reference")
    target = sequences.degap(F.coalesce("target_seq", F.lit("")))
    rows = registry.withColumn("target", target).where("target <> ''")
    code = F.nullif(F.trim(F.coalesce("virus_code", F.lit(""))), F.lit(""))
    virus = rows.agg(F.coalesce(F.max_by(F.coalesce(code, F.lit("UNK")), F.when(F.col("target") == protein, F.col("ordinal"))), F.lit("UNK")).alias("virus"))
    h = sequences.reference_hash(F.lit(protein))
    group = virus.select(F.concat_ws("_", "virus", F.lit(f"{len(protein)}aa"), h).alias("group_id"), h.alias("ref_hash"), F.lit(len(protein)).alias("ref_len"))
    wanted = registry.sparkSession.createDataFrame(sorted(motifs.items()), "tag string, motif string")
    matches = rows.join(F.broadcast(wanted), F.col("target") == F.col("motif")).select("tag", "benchmark_file")
    return group, matches


def register_folder(spark: SparkSession, folder: str, config_path: str, registry: DataFrame) -> tuple[str, DataFrame]:
    """Writes the manifest of a folder that was aligned elsewhere; its canonical group_id, and the matches of its motifs."""
    protein, motifs = config.parse_loosely(files.read_text(spark, config_path))
    group, matches = register(registry, protein, motifs)
    tags = F.array(*(F.lit(t) for t in sorted(motifs))) if motifs else F.array().cast("array<string>")
    row = group.select("group_id", F.to_json(manifest(F.col("group_id"), F.col("ref_hash"), F.col("ref_len"), F.lit(files.qualified(spark, config_path)), tags, F.lit(folder.rstrip("/").rsplit("/", 1)[-1]))).alias("text")).first()
    files.write_text(spark, f"{folder}/{MANIFEST}", row.text + "\n")
    return row.group_id, matches


def document(spark: SparkSession, root: str) -> DataFrame:
    """The catalogue as one row: groups by id with their chunks, and folders without a readable manifest."""
    found = read_manifests(spark, root).where("group_id is not null and ref_hash is not null")
    chunks = probe(listing(spark, root)).select("folder", F.struct("chunk", F.struct("msa_complete", "aligned_proteins", "counts_by_motif", "reusable")).alias("e"))
    inside = chunks.groupBy("folder").agg(F.map_from_entries(F.collect_list("e")).alias("chunks"))
    top = files.qualified(spark, root)
    entry = F.struct("group_id", F.struct(F.concat(F.lit(top + "/"), "folder").alias("folder"), "ref_hash", "ref_len", "config", "chunks"))
    groups = found.join(inside, "folder", "left").agg(F.map_from_entries(F.collect_list(entry)).alias("groups"))
    rest = spark.createDataFrame([(n,) for n in files.folders(spark, root)], "folder string").join(found, "folder", "left_anti").agg(F.array_sort(F.collect_list("folder")).alias("unregistered_folders"))
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return groups.crossJoin(rest).select(F.lit(top).alias("aligned_root"), when.alias("scanned_at"), "groups", "unregistered_folders")  # of one row each
