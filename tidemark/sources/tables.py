"""Registry, catalogues and count tables: CSV, JSON and Parquet readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Columns that a registry must have, and those it may have.
REQUIRED = ["benchmark_file", "dms_id", "virus_code", "host", "target_seq", "target_type", "recommended_reference"]
OPTIONAL = ["seq_len", "uniprot_full_len", "full_protein_seq", "protein"]
NT, AA, TOTAL = "Motif Nucleotide", "Motif Peptide", "Count"

#: Fixed schemas of the documents.
INVENTORY = "fasta_root string, scanned_at string, sample_size int, files array<struct<path:string,rel_path:string,folder:string,molecule:string,state:string,median_length:long,n_records:long,size_bytes:long>>"

PLAN = (
    "created_at string, registry string, inventory string, groups array<struct<group_id:string,virus_code:string,host:string,binning:string,reference_mode:string,ref_len:int,config:string,"
    "motifs:array<struct<tag:string,len:int,benchmarks:array<string>>>,benchmarks:array<string>,fasta_tier:string,fasta_files:array<struct<path:string,rel_path:string,mode:string,state:string,n_records:long>>,"
    "rejected_files:array<struct<file:string,reason:string>>>>, skipped array<struct<benchmark_file:string,reason:string>>, blocked array<struct<benchmark_file:string,reason:string>>, dms_missing_on_disk array<string>"
)
MANIFEST = "group_id string, ref_hash string, ref_len int, config string, motif_tags array<string>, registered_at string, source_folder_name string"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty fields as '', missing optional columns as null; `ordinal` keeps the rows' order. A byte order mark is dropped."""
    raw = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    named = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    filled = named.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in named.columns))
    missing = [F.lit(None).cast("string").alias(c) for c in OPTIONAL if c not in named.columns]
    return filled.select("*", *missing).withColumn("ordinal", F.monotonically_increasing_id())


def missing_columns(registry: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in registry.columns]


def list_benchmarks(spark: SparkSession, folder: str, registry_name: str) -> DataFrame:
    """benchmark_file of the CSV files in a folder, without the registry."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("benchmark_file")).where(F.col("benchmark_file") != registry_name)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of an inventory document."""
    return spark.read.schema(INVENTORY).json(path, multiLine=True).select(F.explode("files").alias("f")).select("f.*")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """One row per group of a task plan."""
    return spark.read.schema(PLAN).json(path, multiLine=True).select(F.explode("groups").alias("g")).select("g.*")


def read_wide_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A wide count table, a file or a folder of part files (the header in the first, or in each); empty keys are '', counts are text until `counts.from_wide` reads them."""
    raw = spark.read.csv(path)
    named = F.array_contains(F.array(*(F.coalesce(F.regexp_replace(c, "^\ufeff", ""), F.lit("")) for c in raw.columns)), NT)
    raw = raw.where(~named).toDF(*(c.lstrip("﻿") for c in raw.where(named).first()))
    return raw.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (NT, AA)})


def read_wide_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path (of the table, a file or a folder of part files), nt, aa, bin, n of many wide count tables in one scan, each table by its own header (of its first part, or of each).

    Keys and labels hold neither commas nor quotes. Totals are no bins; text that is no number and zero counts are left out."""
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    table = F.regexp_replace(file, r"((?:_wide|_training_counts)\.csv)/.*$", "$1")
    lines = spark.read.text(paths).select(table.alias("path"), F.transform(F.split(F.regexp_replace("value", "^\ufeff|\r$", ""), ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', ""))).alias("cells"))
    named = F.array_contains("cells", NT)
    heads = lines.where(named).groupBy("path").agg(F.first("cells").alias("head"))
    rows = lines.where(~named).join(heads, "path")
    at = {c: F.coalesce(F.get("cells", (F.array_position("head", c) - 1).cast("int")), F.lit("")) for c in (NT, AA)}
    each = rows.select("path", at[NT].alias("nt"), at[AA].alias("aa"), F.explode(F.arrays_zip("head", "cells")).alias("c"))
    each = each.where(~F.col("c.head").isin(NT, AA, TOTAL)).select("path", "nt", "aa", F.col("c.head").alias("bin"), F.col("c.cells").try_cast("double").cast("long").alias("n"))
    return each.where(F.col("n") != 0)


def write_counts(counts: DataFrame, path: str) -> None:
    """The long count table as Parquet by group and motif: the primary store."""
    counts.write.mode("overwrite").partitionBy("group_id", "motif_tag").parquet(path)


def read_counts(spark: SparkSession, path: str, group_id: str | None = None, motif_tag: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Only the partitions asked for are read. schema: of a table that may have no rows."""
    df = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    for c, v in (("group_id", group_id), ("motif_tag", motif_tag)):
        df = df if v is None else df.where(F.col(c) == v)
    return df
