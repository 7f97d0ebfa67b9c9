"""Many ordered tables for people from one job: wide CSV files whose rows lie in order; a large table is a folder of numbered parts.

All rows are sorted by ranges of (table, order) and written by Spark's text writer, a folder a table, so a task that is stopped or repeated leaves nothing that counts.
A table of at most `whole` rows and `most` bytes is kept in one range, hence in one file made by one task; the ranges of a larger one follow each other, and its header is the first line of its first part:
`cat TABLE.csv/*` is the table. Only then are files moved to their names, each in one step. What the driver handles grows with the number of tables, not with their rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.sources.tables import AA, NT, TOTAL

WHOLE, MOST = 1_000_000, 64 << 20


@dataclass
class Table:
    labels: list[str]
    paths: list[str]
    total: bool = True


def _lines(long: DataFrame, known: DataFrame) -> DataFrame:
    """table, nt, aa, total and the CSV line of each variant: a count for each label of its table, 0 where there is none."""
    rows = long.groupBy("table", "nt", "aa").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"), F.sum("n").cast("long").alias("total"))
    cells = F.transform("labels", lambda x: F.coalesce(F.try_element_at("counts", x), F.lit(0)).cast("string"))
    keys = F.to_csv(F.struct("nt", "aa"), {"emptyValue": "", "nullValue": ""})
    line = F.array_join(F.concat(F.array(keys), cells, F.when(F.col("counted"), F.array(F.col("total").cast("string"))).otherwise(F.array().cast("array<string>"))), ",")
    return rows.join(known.select("table", "labels", "counted"), "table").select("table", "nt", "aa", "total", line.alias("line"))


def write_wide(long: DataFrame, tables: dict[str, Table], root: str, whole: int = WHOLE, most: int = MOST) -> list[str]:
    """Writes each table to its paths below root, the most counted variants first, ties by key; the paths. Tables without rows have a header alone.

    long: table (a key of `tables`), nt, aa, bin, n; unique by the first four. Bins that a table doesn't name aren't written but are in its total."""
    spark, root = long.sparkSession, root.rstrip("/")
    if not tables:
        return []
    made = f"{root}/_ordered-{uuid.uuid4().hex}"
    heads = [(k, t.labels, t.paths, ",".join([NT, AA, *t.labels, *([TOTAL] if t.total else [])]), t.total) for k, t in tables.items()]
    known = spark.createDataFrame(heads, "table string, labels array<string>, paths array<string>, head string, counted boolean")
    try:
        _lines(long, known).write.parquet(f"{made}/lines")
        lines = spark.read.schema("table string, nt string, aa string, total long, line string").parquet(f"{made}/lines")
        sizes = lines.groupBy("table").agg(F.count("*").alias("n"), F.sum(F.octet_length("line")).alias("bytes"))
        large = [r.table for r in sizes.where((F.col("n") > whole) | (F.col("bytes") > most)).toLocalIterator()]
        rows = lines.withColumn("place", F.lit(1)).unionByName(known.select("table", F.lit(0).alias("place"), F.col("head").alias("line")), allowMissingColumns=True)
        each = rows.join(known.select("table", F.explode("paths").alias("path")), "table").withColumn("name", F.hex(F.encode("path", "UTF-8")))
        order = [F.col("place"), F.desc("total"), F.col("nt"), F.col("aa")]
        if large:
            split = F.col("table").isin(large)
            each = each.repartitionByRange("name", *(F.when(split, c) for c in (F.col("place"), -F.col("total"), F.col("nt"), F.col("aa"))))
        else:
            each = each.repartitionByRange("name")
        each.sortWithinPartitions("name", *order).select("name", F.col("line").alias("value")).write.partitionBy("name").text(f"{made}/tables")
        _publish(spark, f"{made}/tables", root)
    finally:
        files.delete(spark, made)
    return [f"{root}/{p}" for t in tables.values() for p in t.paths]


def _publish(spark, made: str, root: str) -> None:
    parts: dict[str, list[str]] = {}
    for path, _ in files.walk(spark, made):
        folder, _, name = path.rpartition("/")
        if name.startswith("part-"):
            parts.setdefault(folder, []).append(f"{made}/{path}")
    for folder, found in parts.items():
        to = f"{root}/{bytes.fromhex(folder.removeprefix('name=')).decode()}"
        if len(found) == 1:
            files._replace(spark, found[0], to)
        else:
            for k, part in enumerate(sorted(found)):
                files._replace(spark, part, f"{made}/{folder}-parts/part-{k:05d}.csv")
            files.publish(spark, f"{made}/{folder}-parts", to)
