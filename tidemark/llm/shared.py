"""Tables in the shared folder, input loading and integer helpers that the operators have in common."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import sys
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, or (only where that is unset) an own temporary one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, and a lost executor costs no recomputation."""
    small_batches(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_text(column: str):
    """An id on its way to Python: a column of longs with nulls would arrive there as floats, which can't hold all of them."""
    return F.col(column).cast("long").cast("string").alias(column)


def about_chars(docs: DataFrame) -> int:
    """Roughly how many characters the texts have, for numbers of buckets and ranges: twice the size of the files read, or else their sum."""
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if sizes and sum(sizes) < 1 << 60:
        return 2 * sum(sizes)
    return docs.agg(F.sum(F.length("text"))).first()[0] or 0


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made from it, that is no column of df."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


#: Tables up to so many rows of a few numbers (some 40 MB at most) are sent to all tasks; larger ones are joined by shuffle.
SENT = 1_000_000


def small(df: DataFrame, most: int = SENT) -> DataFrame:
    """A written table, marked to be sent to all tasks if it is short enough."""
    return F.broadcast(df) if df.count() <= most else df


def keyed(docs: DataFrame, key: str, nulls: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """docs with a number that tells rows of different texts apart, and a table (key, doc_id) of the keys that are no doc_id (or None).

    The key is doc_id. Of a doc_id that has several texts the one with the least hash keeps it; the others get numbers beyond all ids.
    A null doc_id has no key, or with `nulls` a number beyond all ids for each text. Rows of one doc_id and one text share theirs."""
    own, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    often = cut(docs.groupBy(own.alias("id")).count().where(F.when(F.col("id").isNull(), F.lit(nulls)).otherwise(F.col("count") > 1)).select("id"), "often")
    if often.isEmpty():
        return docs.withColumn(key, own), None
    texts = docs.select(own.alias("id"), text.alias("h")).join(small(often.withColumnRenamed("id", "_i")), F.col("id").eqNullSafe(F.col("_i")), "left_semi").distinct()
    low_of = texts.where("id is not null").groupBy(F.col("id").alias("_i")).agg(F.min("h").alias("low"))
    further = texts.join(low_of, F.col("id") == F.col("_i"), "left").where("low is null or h <> low").select("id", "h")
    low, high = docs.agg(F.min(own), F.max(own)).first()
    number = F.monotonically_increasing_id()
    beyond = number if high is None else F.lit(high) + 1 + number if high < 1 << 62 else F.lit(low) - 1 - number if low > -(1 << 62) else F.xxhash64("id", "h", F.lit(key))
    extra = cut(further.withColumn("s", beyond), "extra")
    if extra.isEmpty():
        return docs.withColumn(key, own), None
    names = {c: free_name(docs, f"_{c}") for c in ("id", "h", "s")}
    rows = docs.join(small(extra.withColumnsRenamed(names)), own.eqNullSafe(F.col(names["id"])) & (text == F.col(names["h"])), "left")
    return rows.withColumn(key, F.coalesce(names["s"], own)).drop(*names.values()), extra.select(F.col("s").alias("key"), F.col("id").alias("doc_id"))


def one_each(docs: DataFrame, ids: DataFrame, id_: str) -> DataFrame:
    """The rows of docs with these ids (a short table with a column `id_`), of each doc_id only the one with the least hash of its text: as many rows as ids, however often one occurs.

    Ties go by the other columns. The result has the columns of docs."""
    rows = docs.join(F.broadcast(ids.select(F.col(id_).alias("_id")).distinct()), F.col("doc_id") == F.col("_id"), "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    least = rows.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.struct(F.xxhash64("text"), *rest)).alias("_x"))
    return least.select("doc_id", *(F.col(f"_x.{c}").alias(c) for c in rest)).select(*docs.columns)


def doc_of(df: DataFrame, column: str, extra: DataFrame | None) -> DataFrame:
    """df with the doc_id of each key in place of the key."""
    if extra is None:
        return df
    at = small(extra.select(F.col("key").alias("_key"), F.col("doc_id").alias("_doc_of")))
    return df.join(at, F.col(column) == F.col("_key"), "left").withColumn(column, F.coalesce("_doc_of", column)).drop("_key", "_doc_of")


def with_each(df: DataFrame, facts: DataFrame, key: str, hot: int = 2_000) -> DataFrame:
    """df joined with one row of facts per key. Keys with more than `hot` rows don't meet in one task: their facts are sent to all."""
    often = cut(df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select(key), "hot")
    if often.isEmpty():
        return df.join(facts, key)
    sent = small(often)
    some = cut(facts.join(sent, key, "left_semi"), "hot_facts")
    return df.join(sent, key, "left_anti").join(facts, key).unionByName(df.join(small(some), key))


class Ranges:
    """Ranges of (doc_id, tie) of about equal numbers of rows, null ids first. Ties are fractions; ids with many rows are split by them."""

    def __init__(self, docs: DataFrame, n: int):
        """docs: a column doc_id of whole numbers."""
        self.nulls, cuts, self.ties = np.zeros(0), set(), {}
        if n > 1:
            cuts |= {int(x) for x in docs.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)}
            size = max(1, docs.count() // n)
            for r in docs.groupBy("doc_id").agg(F.count("*").alias("c")).where(F.col("c") > 2 * size).collect():  # n / 2 at most
                ties = np.arange(1, r.c // size) * (size / r.c)
                if r.doc_id is None:
                    self.nulls = np.append(ties, 1.0)
                else:
                    self.ties[int(r.doc_id)] = ties
                    cuts |= {int(r.doc_id), int(r.doc_id) + 1}
        self.cuts = np.array(sorted(c for c in cuts if -(1 << 63) <= c < 1 << 63), np.int64)
        self.split = np.array(sorted(self.ties), np.int64)
        self.before = np.concatenate(([0], np.cumsum([len(self.ties[i]) for i in self.split.tolist()]))).astype(np.int64)

    def of(self, ids: np.ndarray, known: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The range of each row; ids of rows that aren't known don't matter."""
        out = len(self.nulls) + np.searchsorted(self.cuts, ids, "right") + self.before[np.searchsorted(self.split, ids, "left")]
        for i, t in self.ties.items():
            own = np.flatnonzero(ids == i)
            out[own] += np.searchsorted(t, ties[own], "right")
        return np.where(known, out, np.searchsorted(self.nulls, ties, "right"))


def longs(values) -> pd.api.extensions.ExtensionArray:
    """Whole numbers, or their text, or None, exactly."""
    return pd.array([None if v is None else int(v) for v in values], dtype="Int64")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows where the session has Spark's 10,000, which of long texts would take much memory in each worker."""
    if spark.conf.get(BATCH, "10000") == "10000":
        spark.conf.set(BATCH, "1000")


def trim() -> None:
    """Gives the memory that a worker has freed back to the machine, as other workers and the JVM share a bound."""
    gc.collect()
    if sys.platform.startswith("linux") and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run):
    """A function for mapInPandas that leaves its worker small when its task ends."""

    def inner(frames):
        try:
            yield from run(frames)
        finally:
            trim()

    return inner


def let_go() -> None:
    """Frees what a worker keeps for token operators (about 100 MB), when it goes on with another operator."""
    tokens = sys.modules.get("tidemark.llm.tokens")
    if tokens is not None and tokens._encoders:
        tokens._encoders.clear()
        trim()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int):
    """crc32 of the id written as text, mod n; null ids count as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n)), F.lit(0).cast("long"))
