"""What is left to do, and in which waves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unfinished(planned: DataFrame, finished: DataFrame, on: list[str]) -> DataFrame:
    return planned.join(finished.select(*on).distinct(), on, "left_anti")


def waves(groups: DataFrame, size: int, group: str = "group_id", files: str = "files") -> DataFrame:
    """group and wave: each group of several files alone, all of these first; then the others in slices of `size`.

    The numbering orders groups, of which a plan has some hundred; it isn't made for records."""
    many = F.col(files) > 1
    rank = F.row_number().over(W.partitionBy(many).orderBy(group))
    rows = groups.select(group, many.alias("alone"), rank.alias("rank"))
    before = groups.agg(F.coalesce(F.sum(many.cast("int")), F.lit(0)).alias("before"))
    wave = F.when(F.col("alone"), F.col("rank") - 1).otherwise(F.col("before") + F.floor((F.col("rank") - 1) / size))
    return rows.crossJoin(F.broadcast(before)).select(group, wave.cast("long").alias("wave"))


def only(groups: DataFrame, text: str | None, group: str = "group_id") -> DataFrame:
    return groups if text is None else groups.where(F.contains(group, F.lit(text)))


def catalogue(alignments: DataFrame, chunks: DataFrame) -> DataFrame:
    """Aligned groups with a map of their chunks. alignments: group_id, ref_hash, ref_len, config. chunks: group_id, chunk, msa_complete, aligned_proteins, counts_by_motif."""
    entry = F.struct("msa_complete", "aligned_proteins", "counts_by_motif", (F.col("msa_complete") & F.col("aligned_proteins")).alias("reusable"))
    inside = chunks.groupBy("group_id").agg(F.map_from_entries(F.collect_list(F.struct("chunk", entry))).alias("chunks"))
    return alignments.join(inside, "group_id", "left")
