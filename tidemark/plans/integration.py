"""Counts over all datasets of an output folder, kept up to date: only datasets whose counts changed are read again.

OUT/_integration/state.json names the sums that hold, and for each dataset the digest of the counts that are in them. A dataset's digest is that of its store's
file names and sizes, which every write makes anew, so nothing is read to find what changed. What a dataset gave is kept as a copy under its digest: when the
dataset changes or goes, the copy is taken off, and the new counts are added. New sums and copies are written beside the old ones, then the state is replaced in
one step, then the old ones are deleted: a run that is stopped anywhere leaves the former state whole, and the next run starts from it. Tables that are still to
be made again stand in the state until `finish`, so a run that is stopped among them is made good as well."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import counts
from tidemark.sources import files

STORE = "variant_counts"
KEYS = ["infix", *counts.KEYS, "year", "month"]
COUNTED = "infix string, nt string, aa string, year int, month int, n long"


def _folder(output: str) -> str:
    return f"{output.rstrip('/')}/_integration"


def state(spark: SparkSession, output: str) -> dict:
    """sums: the folder that holds (null: nothing was summed); datasets: name to digest; options of the tables; pending: infixes whose tables are to be made again."""
    path = f"{_folder(output)}/state.json"
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else {"sums": None, "datasets": {}, "options": None, "pending": []}


def digests(spark: SparkSession, output: str) -> dict[str, str]:
    """The digest of each dataset's store."""
    out = {}
    for dataset in files.folders(spark, output):
        listed = [(p, n) for p, n in files.walk(spark, f"{output}/{dataset}/{STORE}") if p.endswith(".parquet")]
        if listed:
            out[dataset] = hashlib.sha1(json.dumps([dataset, listed]).encode()).hexdigest()
    return out


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(COUNTED).parquet(*paths) if paths else spark.createDataFrame([], COUNTED)


def sums(spark: SparkSession, output: str) -> DataFrame:
    """infix, nt, aa, year, month, n over all datasets, as last integrated."""
    held = state(spark, output)["sums"]
    return _read(spark, [f"{_folder(output)}/{held}"] if held else [])


def update(spark: SparkSession, output: str, options: dict | None = None) -> list[str]:
    """Brings the sums up to date; the infixes whose tables are to be made again, which are all where the options are others than before.

    The datasets that changed and the sums that held are read, no other. A dataset that is gone is taken off. Without a change nothing is written."""
    output, top = output.rstrip("/"), _folder(output)
    before, now = state(spark, output), digests(spark, output)
    held = before["datasets"]
    changed = sorted(d for d, k in now.items() if held.get(d) != k)
    gone = sorted(k for d, k in held.items() if now.get(d) != k)
    if not changed and not gone and before["options"] == options:
        return before["pending"]
    after = {"sums": before["sums"], "datasets": now, "options": options}
    infixes = set(before["pending"])
    if changed or gone:
        for d in changed:
            _read(spark, [f"{output}/{d}/{STORE}/*"]).write.mode("overwrite").parquet(f"{top}/parts/{now[d]}")
        added = _read(spark, [f"{top}/parts/{now[d]}" for d in changed])
        taken = _read(spark, [f"{top}/parts/{k}" for k in gone])
        delta = added.unionByName(taken.withColumn("n", -F.col("n")))
        total = sums(spark, output).unionByName(delta).groupBy(*KEYS).agg(F.sum("n").cast("long").alias("n")).where("n <> 0")
        after["sums"] = f"sums-{uuid.uuid4().hex}"
        total.write.parquet(f"{top}/{after['sums']}")
        infixes |= {r.infix for r in delta.select("infix").distinct().toLocalIterator()}
    if before["options"] != options and after["sums"]:
        infixes |= {r.infix for r in _read(spark, [f"{top}/{after['sums']}"]).select("infix").distinct().toLocalIterator()}
    after["pending"] = sorted(infixes)
    files.write_text(spark, f"{top}/state.json", json.dumps(after, sort_keys=True))
    _sweep(spark, top, after)
    return after["pending"]


def finish(spark: SparkSession, output: str) -> None:
    """The tables that `update` named have been made."""
    held = state(spark, output)
    if held["pending"]:
        files.write_text(spark, f"{_folder(output)}/state.json", json.dumps(held | {"pending": []}, sort_keys=True))


def _sweep(spark: SparkSession, top: str, after: dict) -> None:
    """Deletes sums and copies that the state doesn't name, also those of runs that were stopped."""
    kept = {after["sums"], "parts"} | set(after["datasets"].values())
    for where in (top, f"{top}/parts"):
        for name in files.folders(spark, where):
            if name not in kept:
                files.delete(spark, f"{where}/{name}")
