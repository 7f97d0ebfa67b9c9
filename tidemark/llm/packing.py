"""Packing: concatenate and cut.

Pass one encodes every document where it lies, and writes its ids with its place inside its partition to the shared folder.
The partitions' totals, summed up in partition order, give each partition's global offset (one row a partition). Pass two
cuts the one long row of ids into windows of 2048: a document that lies over a boundary leaves a record on both sides. Only
the last sequence is shorter than 2048. Nothing is shuffled but the totals.

A null or empty text is one end id. Rows with repeated or null doc_id are packed like any others. Other columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import as_text, cut, longs, table, trimmed
from tidemark.llm.tokens import encoder

LENGTH, END = 2048, 1
#: Partition totals up to this many rows (16 bytes each) are sent to all tasks; more are joined by shuffle.
SENT = 500_000


def with_bases(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds base, the sum of n over all smaller parts, to rows with a part. totals: part, n."""
    bases = cut(totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base")), "bases")
    return df.join(F.broadcast(bases) if bases.count() <= SENT else bases, "part")


def _first(path: str | None, end: int):
    def run(frames):
        from pyspark import TaskContext

        part, at, coder = TaskContext.get().partitionId(), 0, encoder(path)
        for f in frames:
            rows = []
            for doc, ids in zip(f.doc_id.tolist(), coder.encode(f.text), strict=True):
                ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end))
                rows.append((part, doc, at, len(ids), (ids.astype("<u2") if narrow(ids) else ids).tobytes()))
                at += len(ids)
                if len(rows) >= 1000:
                    yield framed(rows, COLUMNS)
                    rows = []
            if rows:
                yield framed(rows, COLUMNS)

    return run


def framed(rows, columns) -> pd.DataFrame:
    """A frame with a column doc_id of numbers, their text or None."""
    f = pd.DataFrame(rows, columns=columns, dtype=object)
    return f.assign(doc_id=longs(f.doc_id))


COLUMNS = ["part", "doc_id", "at", "n", "ids"]


def narrow(ids: np.ndarray) -> bool:
    return int(ids.max(initial=0)) < 1 << 16


def wide(raw: bytes, n: int) -> np.ndarray:
    """The ids of a row: two bytes each if all are below 65536, else four."""
    return np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * n else np.frombuffer(raw, "<u4")


def pieces(ids: np.ndarray, at: int, length: int):
    """(start, length, crc32, sequence, offset) of the windows that the ids reach, if the first lies at place `at` of all."""
    raw, start = memoryview(ids.tobytes()), 0
    while start < len(ids):
        sequence, offset = divmod(at + start, length)
        n = min(length - offset, len(ids) - start)
        yield start, n, zlib.crc32(raw[4 * start : 4 * (start + n)]), sequence, offset
        start += n


def _second(length: int):
    def run(frames):
        for f in frames:
            out = [
                (doc, start, n, crc, total, sequence, offset)
                for doc, place, total, raw in zip(f.doc_id.tolist(), f.place.tolist(), f.n.tolist(), f.ids, strict=True)
                for start, n, crc, sequence, offset in pieces(wide(raw, total), place, length)
            ]
            yield framed(out, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = docs.select(as_text("doc_id"), "text")
    ids = cut(docs.mapInPandas(trimmed(_first(path, end)), "part long, doc_id long, at long, n long, ids binary"), "ids", "zstd")
    placed = with_bases(ids, ids.groupBy("part").agg(F.sum("n").alias("n")))
    return placed.select(as_text("doc_id"), (F.col("base") + F.col("at")).alias("place"), "n", "ids").mapInPandas(
        trimmed(_second(length)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
