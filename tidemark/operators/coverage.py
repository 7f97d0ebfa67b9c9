"""K-mers that many sequences share with few references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import sequences

#: K-mers of references (some 60 bytes each) that are sent to all tasks; more are joined by shuffle.
SENT = 500_000
_FACTOR = 0x9E3779B97F4A7C15


def _numbers(text: str) -> np.ndarray:
    """A number for each window of ten letters, by windows of two, four and eight."""
    one = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    if len(one) < sequences.KMER:
        return one[:0]
    by = [np.uint64(pow(_FACTOR, n, 1 << 64)) for n in (1, 2, 4, 8)]
    two = one[:-1] + one[1:] * by[0]
    four = two[:-2] + two[2:] * by[1]
    eight = four[:-4] + four[4:] * by[2]
    return eight[:-2] + two[8:] * by[3]


def _slots(numbers: np.ndarray) -> np.ndarray:
    return numbers >> np.uint64(44)


def hits(records: DataFrame, kmers: DataFrame, record: str, seq: str) -> DataFrame:
    """record and k, once each, of the windows that may be among the k-mers (SENT rows at most): those of equal number."""
    known = np.unique(np.array([_numbers(r.k)[0] for r in kmers.select("k").distinct().collect()], np.uint64))
    taken = np.zeros(1 << 20, bool)
    taken[_slots(known)] = True

    def run(frames):
        for f in frames:
            rows = []
            for r, text in zip(f[record], f.seq, strict=True):
                if text and len(known):
                    numbers = _numbers(text)
                    at = np.flatnonzero(taken[_slots(numbers)])
                    at = at[known[np.minimum(np.searchsorted(known, numbers[at]), len(known) - 1)] == numbers[at]]
                    rows += [(r, k) for k in {text[i : i + sequences.KMER] for i in at.tolist()}]
            yield pd.DataFrame(rows, columns=[record, "k"], dtype=object)

    name = records.schema[record].dataType.simpleString()
    return records.select(F.col(record).cast("string").alias(record), F.col(seq).alias("seq")).mapInPandas(run, f"`{record}` string, k string").withColumn(record, F.col(record).cast(name))


def shared_kmers(records: DataFrame, references: DataFrame, record: str, reference: str, seq: str = "seq", least: float = 0.3) -> DataFrame:
    """record, reference, shared and kmers (distinct, of the reference) of the pairs that share at least this part of the reference's k-mers.

    The references' k-mers, if they are few, are sent to all tasks, as numbers; only windows of such a number become texts, are joined and shuffled."""
    each = references.select(reference, F.explode(sequences.kmers(seq)).alias("k"))
    n = each.groupBy(reference).agg(F.count("*").alias("kmers"))
    if each.limit(SENT + 1).count() <= SENT:
        words, known = hits(records, each, record, seq), F.broadcast(each)
    else:
        words, known = records.select(record, F.explode(sequences.kmers(seq)).alias("k")), each
    shared = words.join(known, "k").distinct().groupBy(record, reference).agg(F.count("*").alias("shared"))
    return shared.join(n, reference).where(F.col("shared") >= least * F.col("kmers")).select(record, reference, "shared", "kmers")
