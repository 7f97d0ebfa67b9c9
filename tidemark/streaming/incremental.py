"""New files counted as they come: each micro-batch adds its long counts to a table that is summed when read.

A record belongs to its file, so no state is kept between batches, and a batch that is run again overwrites its own folder:
counts are exact whatever fails. Calendar bins aren't windows of event time: a record may have a year and no month."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import counts
from tidemark.sources import fasta, files


def count_stream(records: DataFrame, to_fragments, path: str, checkpoint: str, keys: list[str] = counts.KEYS):
    """Starts a query that counts what is there and ends. records: a stream; to_fragments: records -> keys, year, month."""

    def add(batch: DataFrame, number: int) -> None:
        counts.count_variants(to_fragments(batch), keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _state(spark: SparkSession, path: str) -> dict:
    """base: the folder of compacted counts; through: the last batch in it."""
    held = f"{path}/_compacted/state.json"
    return json.loads(files.read_text(spark, held)) if files.exists(spark, held) else {"base": None, "through": -1}


def read_stream_counts(spark: SparkSession, path: str, keys: list[str] = counts.KEYS) -> DataFrame:
    """The sum of the compacted counts and the batches after them; no rows, with keys as text, where nothing was counted yet."""
    held = _state(spark, path)
    if held["base"] is None and not any(name.startswith("batch=") for name in files.folders(spark, path)):
        rows = spark.createDataFrame([], ", ".join(f"`{k}` string" for k in keys) + ", year int, month int, n long")
    elif held["base"] is None:
        rows = spark.read.parquet(path)
    else:
        base = spark.read.parquet(f"{path}/_compacted/{held['base']}")
        new = spark.read.schema(T.StructType([*base.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
        rows = base.unionByName(new.where(F.col("batch") > held["through"]).drop("batch"))
    return rows.groupBy(*keys, "year", "month").agg(F.sum("n").cast("long").alias("n"))


def compact(spark: SparkSession, path: str, keys: list[str] = counts.KEYS, beyond: int = 0) -> bool:
    """Sums batches into one table, where there are more of them than `beyond`; not while a stream writes.

    The new table is written beside the old one, and the state that names it is replaced in one step. Batches that are in it don't count from then on, also one that
    is run again later; they and older tables are deleted last, so a run that is stopped anywhere changes no count."""
    held = _state(spark, path)
    found = [int(name.removeprefix("batch=")) for name in files.folders(spark, path) if name.startswith("batch=")]
    new = [b for b in found if b > held["through"]]
    if len(new) > beyond:
        base = f"counts-{uuid.uuid4().hex}"
        read_stream_counts(spark, path, keys).write.parquet(f"{path}/_compacted/{base}")
        held = {"base": base, "through": max(new)}
        files.write_text(spark, f"{path}/_compacted/state.json", json.dumps(held))
    for b in found:
        if b <= held["through"]:
            files.delete(spark, f"{path}/batch={b}")
    for name in files.folders(spark, f"{path}/_compacted"):
        if name != held["base"]:
            files.delete(spark, f"{path}/_compacted/{name}")
    return len(new) > beyond


def count_folder(spark: SparkSession, folder: str, to_fragments, path: str, checkpoint: str, keys: list[str] = counts.KEYS, files_per_batch: int = 1000, beyond: int = 20) -> DataFrame:
    """Counts the FASTA files below a folder that no earlier call has taken; the counts over all files so far. More than `beyond` batches are compacted."""
    path = path.rstrip("/")
    count_stream(fasta.stream_fasta(spark, folder, files_per_batch), to_fragments, path, checkpoint, keys).awaitTermination()
    compact(spark, path, keys, beyond)
    return read_stream_counts(spark, path, keys)
