"""Keeps counts of motif variants by dataset and month up to date with a folder of sequence records that grows.

    python jobs/variant_feed.py --records DIR --out DIR --checkpoint DIR [--config FILE]

Each run takes the files that no earlier run has taken (a file stream with a checkpoint, which ends when there are no more), picks the motif's codons from each
record, parses its date and counts. A micro-batch writes its counts to OUT/increments/batch=N, by dataset; one that is run again overwrites its own folder. Then
the datasets with new increments are summed: OUT/counts, partitioned by dataset, holds for each dataset the counts up to increment `through`, which is its high-water
mark. Only increments beyond it are added, to a staged copy that then takes the place of those datasets' partitions alone. So a run that is stopped anywhere is made
good by the next: a batch that isn't committed is taken again, increments that aren't in the counts yet are added, and a dataset whose partition is missing is
summed anew from all its increments. A run without new files changes nothing.

The configuration says, in SQL expressions over the records' columns, what the dataset, the header with the date, and the aligned nucleotides are, and which codon
columns the motif has. A null dataset is `unknown`; a record with too few called codons (an empty or null text has none) isn't counted; a header without a date
has null year and month."""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import counts, motif

log = logging.getLogger("jobs.variant_feed")
CONFIG = Path(__file__).with_suffix(".json")
KEYS = ["dataset", "nt", "aa"]
COUNTED = "nt string, aa string, year int, month int, n long"
PUBLISHED, INCREMENT = f"{COUNTED}, through long, dataset string", f"{COUNTED}, batch long, dataset string"


def fragments(rows: DataFrame, config: dict) -> DataFrame:
    """dataset, nt, aa, year, month of each record that has the motif."""
    found = rows.select(F.coalesce(F.expr(config["dataset"]).cast("string"), F.lit("unknown")).alias("dataset"), dates.parse_date(F.expr(config["header"])).alias("date"), F.expr(config["nt"]).alias("aln_nt"))
    found = found.select("dataset", "date.year", "date.month", "aln_nt")
    return motif.extract_codons(found, config["columns"], "aln_nt", config["least_called"])


def take_new(spark: SparkSession, records: str, out: str, checkpoint: str, config: dict) -> int:
    """Counts the files that weren't taken yet, batch by batch; how many records they hold."""
    taken = []

    def add(batch: DataFrame, number: int) -> None:
        seen = Observation(f"batch {number}")
        rows = fragments(batch.observe(seen, F.count(F.lit(1)).alias("records")), config)
        counts.count_variants(rows, KEYS).write.mode("overwrite").partitionBy("dataset").parquet(f"{out}/increments/batch={number}")
        taken.append(seen.get["records"])
        log.info("batch %d: read %d records of %s, wrote %s/increments/batch=%d", number, taken[-1], records, out, number)

    where = f"{records[:-1]}[{records[-1]}]"  # a stream reads what a pattern matches, be it a folder or a single file
    stream = spark.readStream.schema(spark.read.parquet(records).schema).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(where)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sum(taken)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """dataset, nt, aa, year, month, n, and through: the last increment that is counted."""
    return _read(spark, f"{out}/counts", PUBLISHED)


def publish(spark: SparkSession, out: str) -> int:
    """Adds the increments beyond each dataset's mark to its counts; the number of datasets that had any."""
    held = read_counts(spark, out)
    mark = held.groupBy("dataset").agg(F.max("through").alias("mark"))
    made = _read(spark, f"{out}/increments", INCREMENT).join(mark, "dataset", "left")
    new = made.where("mark is null or batch > mark").drop("mark")
    if new.isEmpty():
        return 0
    last = new.groupBy("dataset").agg(F.max("batch").alias("through"))
    both = new.drop("batch").unionByName(held.drop("through").join(last, "dataset", "left_semi"))
    total = counts.integrate([both], KEYS).join(last, "dataset")
    total.write.mode("overwrite").partitionBy("dataset").parquet(f"{out}/staged")
    staged = _read(spark, f"{out}/staged", PUBLISHED)
    staged.hint("rebalance", "dataset").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(f"{out}/counts")
    return staged.select("dataset").distinct().count()


def run(spark: SparkSession, records: str, out: str, checkpoint: str, config: dict) -> DataFrame:
    """Takes what is new and brings the counts up to date; the counts as they stand."""
    records, out = records.rstrip("/"), out.rstrip("/")
    read = take_new(spark, records, out, checkpoint, config)
    touched = publish(spark, out)
    found = read_counts(spark, out)
    log.info("read %d new records of %s; wrote the counts of %d datasets to %s/counts, which holds %d rows", read, records, touched, out, found.count())
    return found


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("records", "out", "checkpoint"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", default=str(CONFIG))
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("variant_feed").getOrCreate()
    try:
        run(spark, a.records, a.out, a.checkpoint, json.loads(Path(a.config).read_text()))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
