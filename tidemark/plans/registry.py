"""Registry validation: set comparison with what is on disk, and row rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import sequences
from tidemark.sources.config import RESIDUES
from tidemark.sources.tables import REQUIRED

#: Reference modes. The letters of a target are those that a configuration may have.
MODES = ("target_as_reference", "full_protein_plus_motif")


def compare(disk: DataFrame, registry: DataFrame, key: str = "benchmark_file") -> DataFrame:
    """key and status: ok (in both), new (only on disk), missing (only in the registry)."""
    a, b = disk.select(key).distinct(), registry.select(key).distinct()
    return a.intersect(b).withColumn("status", F.lit("ok")).union(a.subtract(b).withColumn("status", F.lit("new"))).union(b.subtract(a).withColumn("status", F.lit("missing")))


def violations(registry: DataFrame, key: str = "benchmark_file") -> DataFrame:
    """key, rule, severity for each row that breaks a rule."""
    clean = sequences.degap("target_seq", upper=False)
    rules = [
        *((f"empty {c}", "problem", F.coalesce(F.trim(c), F.lit("")) == "") for c in REQUIRED),
        ("letters of target_seq", "problem", F.length(F.translate(F.upper(clean), "".join(sorted(RESIDUES)), "")) > 0),
        ("seq_len", "warning", (F.coalesce(F.trim("seq_len"), F.lit("")) != "") & ~F.coalesce(F.col("seq_len").try_cast("double").cast("long").isin(F.length("target_seq"), F.length(clean)), F.lit(False))),
        ("recommended_reference", "problem", ~F.coalesce(F.trim("recommended_reference"), F.lit("")).isin("", *MODES)),
    ]
    found = [registry.where(F.coalesce(test, F.lit(False))).select(key, F.lit(rule).alias("rule"), F.lit(severity).alias("severity")) for rule, severity, test in rules]
    twice = registry.groupBy(key).count().where("count > 1").select(key, F.lit("occurs twice").alias("rule"), F.lit("problem").alias("severity"))
    return reduce(DataFrame.unionByName, [*found, twice])
