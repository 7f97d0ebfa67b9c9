"""The corpus pipeline: documents that pass toxicity, near-duplicate, repeated-passage and benchmark stages, packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. `run` writes each stage's rows as Parquet to the shared folder and rereads them for the next.

A null or empty text is never toxic, near or leaking: such rows pass, and are packed as an end id. Rows of one doc_id and one text
count as one document in the second stage; rows of one doc_id with different texts are judged each by its text. Rows with a null doc_id pass
the second and third stage; the toxicity and the leaks of their text are judged. Very long texts are judged whole, extra columns are kept,
empty tables stay empty. Of a group the row with the smallest doc_id stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, ngram_join, packing, substring_dedup, toxicity
from tidemark.llm.shared import cut, free_name, keyed, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.trained(docs.select("doc_id", "text"), toxicity.labels_of(spark, sf_dir, "toxic"))
    score, toxic = free_name(docs, "_toxic_score"), free_name(docs, "_toxic")
    return toxicity.toxicity(docs, model, score, toxic).where(F.col(toxic) == 0).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, doc = free_name(docs, "_key"), free_name(docs, "_doc")
    rows, _ = keyed(docs, key)
    found = ngram_join.components_by_key(rows.select(F.col(key).alias("doc_id"), "text")).where("doc_id is not null")
    found = cut(found.select(F.col("doc_id").alias(doc), (F.col("doc_id") == F.col("component_id")).alias("stays")), "groups")
    dropped = found.where("not stays").select(doc).distinct()
    kept = rows.join(dropped, rows[key] == dropped[doc], "left_anti")
    repeated = cut(found.where("stays").groupBy(doc).count().where("count > 1").select(doc), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, kept[key] == repeated[doc], "left_semi").dropDuplicates([key])
        kept = kept.join(repeated, kept[key] == repeated[doc], "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, doc = free_name(docs, "_key"), free_name(docs, "_doc")
    rows, _ = keyed(docs, key, nulls=True)
    found = decontamination.leaks(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = cut(found.select(F.col("doc_id").alias(doc)).distinct(), "leaking")
    return rows.join(found, rows[key] == found[doc], "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("substring_dedup", remove_repeated_passages),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack),
]
#: None of the stages' decisions can be stated in SQL; tests/llm has a brute-force twin of the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
