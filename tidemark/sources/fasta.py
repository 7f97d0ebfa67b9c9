"""FASTA as a distributed source, and its writer.

Files are split at record starts by Spark's text reader (record separator: line feed and >), so one file is read by many tasks. A
record's place is its file, the byte block it was read from and its number there, which keeps file order without a global sort.

A large file may be a folder of parts: NAME.fasta/part-00000.fasta and so on, which read by name hold its records in order. It is listed, counted and run as one file called
NAME.fasta; the file_path of its records is that of the part, so file_path and ordinal order them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import texts
from tidemark.sources import files

EXTENSIONS = ("fasta", "fa", "fna", "faa", "fas")
#: The end of a part's path, after the name of its file.
_PART = r"(?i)([^/]\.(?:%s))/part-\d+\.(?:%s)$" % (("|".join(EXTENSIONS),) * 2)
_REST = 2147483647
#: Letters of a written line.
LINE = 60


def name_filter() -> str:
    """A file pattern of the extensions in any case."""
    return "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in e) for e in EXTENSIONS) + "}"


@F.pandas_udf(T.LongType())
def _number(split: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The number of each row among those of its split, which a task reads one after the other. Only hashes of splits come here."""
    last, n = None, 0
    for s in split:
        v = s.to_numpy(np.int64)
        new = np.ones(len(v), bool)
        new[1:] = v[1:] != v[:-1]
        new[:1] = last is None or v[:1] != last
        at = np.arange(len(v))
        begin = np.maximum.accumulate(np.where(new, at, -1))
        out = np.where(begin >= 0, at - begin, at + n)
        if len(v):
            last, n = v[-1], int(out[-1]) + 1
        yield pd.Series(out)


def file_name(path: str = "file_path") -> Column:
    """The file's path without URL escapes, and without the scheme of the local file system."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def whole(path: str | Column = "file_path") -> Column:
    """The path of the file that a part belongs to; other paths as they are."""
    return F.regexp_replace(path, _PART, "$1")


def read_fasta(spark: SparkSession, path: str | list[str], recursive: bool = False, encoding: str = "ISO-8859-1") -> DataFrame:
    """file_path, dataset (the file's name without extension), block, number, ordinal, rec_id, description, seq (upper case, without white space) of each record.

    ordinal orders the records of a file; it is not dense; number counts from 0 in each block. Text before a file's first header is
    no record. A header without a name has an empty rec_id. Empty files give no rows. Bytes are read as ISO-8859-1 unless told otherwise."""
    reader = spark.read.option("lineSep", "\n>")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name_filter())
    return _parsed(reader.text(path), encoding)


def stream_fasta(spark: SparkSession, folder: str, files_per_batch: int = 1000, encoding: str = "ISO-8859-1") -> DataFrame:
    """The same records as a stream of the FASTA files below a folder, each file once. A file must be put into the folder whole (by a rename)."""
    reader = spark.readStream.option("lineSep", "\n>").option("recursiveFileLookup", "true").option("pathGlobFilter", name_filter())
    return _parsed(reader.option("maxFilesPerTrigger", files_per_batch).text(folder), encoding)


def _parsed(lines: DataFrame, encoding: str) -> DataFrame:
    """The records of what was read between record starts."""
    raw = lines.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"))
    raw = raw.withColumn("number", _number.asNondeterministic()(F.xxhash64("file_path", "block")))
    text = F.col("value") if encoding.upper().replace("-", "") == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    first = (F.col("block") == 0) & (F.col("number") == 0)
    body = F.when(~first, text).when(F.startswith("value", F.lit(">")), F.substring(text, 2, _REST))
    head = F.regexp_replace(F.substring_index("body", "\n", 1), r"\r$", "")
    tail = F.when(F.contains("body", F.lit("\n")), F.substring(F.col("body"), F.instr("body", F.lit("\n")) + 1, F.length("body"))).otherwise("")
    rows = raw.withColumn("body", F.explode(F.array_compact(F.array(body)))).withColumn("description", F.trim(head))
    path_ = file_name()
    return rows.select(
        path_.alias("file_path"), texts.file_stem(whole(path_)).alias("dataset"), "block", "number",
        (F.col("block") * F.lit(4096) + F.col("number")).alias("ordinal"),
        F.regexp_extract("description", r"^(\S*)", 1).alias("rec_id"), "description",
        F.upper(F.regexp_replace(tail, r"\s", "")).alias("seq"))


def first_records(records: DataFrame, n: int, by: str = "file_path", order: str | list[str] = "ordinal") -> DataFrame:
    """The first n records of each file; n = 0: all. Of each block only the first n go further, where records know their number."""
    if not n:
        return records
    if "number" in records.columns:
        records = records.where(F.col("number") <= n)  # number 0 may be text before the first header
    return records.withColumn("_n", F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def count_records(records: DataFrame) -> DataFrame:
    """file_path and n_records of each file; one in parts is one file."""
    return records.groupBy(whole().alias("file_path")).agg(F.count("*").alias("n_records"))


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """path and size_bytes of the FASTA files of a folder, or of all under it; empty files too. One in parts is one file, of their size together."""
    top, sizes = files.qualified(spark, root).rstrip("/"), {}
    for made, n in files.walk(spark, root):
        p = re.sub(_PART, r"\1", made)
        if p.lower().endswith(tuple(f".{e}" for e in EXTENSIONS)) and (recursive or "/" not in p):
            sizes[p] = sizes.get(p, 0) + n
    return spark.createDataFrame([(f"{top}/{p}", n) for p, n in sizes.items()], "path string, size_bytes long")


def datasets(spark: SparkSession, folder: str, dataset: str | None = None) -> DataFrame:
    """path, size_bytes and dataset of the FASTA files of a folder, in order of path; dataset: only the file of this name, or of its name without extension.

    A dataset is called by its file's name without extension, or with it where two files of the folder differ in that alone."""
    found = list_files(spark, folder, False).withColumn("stem", texts.file_stem("path"))
    own = found.groupBy("stem").count()
    found = found.join(own, "stem").withColumn("dataset", F.when(F.col("count") > 1, F.substring_index("path", "/", -1)).otherwise(F.col("stem")))
    if dataset is not None:
        stem = dataset.rsplit(".", 1)[0] if "." in dataset[1:] else dataset
        found = found.where((F.substring_index("path", "/", -1) == dataset) | (F.col("stem") == dataset) | ((F.col("stem") == stem) & (F.col("count") == 1)))
    return found.select("path", "size_bytes", "dataset").orderBy("path")


def single_sequence(spark: SparkSession, path: str) -> str | None:
    """The first record's sequence; null if there is none."""
    row = read_fasta(spark, path).agg(F.min_by("seq", F.struct("file_path", "ordinal")).alias("seq")).first()
    return row.seq or None


def write_fasta(records: DataFrame, path: str, seq: str = "seq", order: tuple[str, ...] = ()) -> None:
    """One record a row, lines of 60 letters; a folder of text files. With an order the files, read by name, hold the records in it.

    A null description or sequence is written as an empty one; a sequence of none has only its header."""
    if order:
        records = records.select("description", seq, *(c for c in order if c != seq)).orderBy(*order)
    lines = F.regexp_replace(F.coalesce(F.col(seq), F.lit("")), f"(.{{{LINE}}})(?=.)", "$1\n")
    text = F.concat(F.lit(">"), F.coalesce("description", F.lit("")), F.when(lines != "", F.concat(F.lit("\n"), lines)).otherwise(""))
    records.select(text.alias("value")).write.mode("overwrite").text(path)
