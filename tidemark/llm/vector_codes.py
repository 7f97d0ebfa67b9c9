"""Compression of vectors to codes, a byte for each part, with VA-file filtering of the entries.

A component x becomes the integer floor(1024 x), and a vector is cut into equal consecutive parts. Each part position has its own codebook,
which starts as that part of the vectors of the smallest ids; rounds assign every part to its nearest entry and replace each entry by the mean of its
parts, rounded down. Each round is one pass over all rows; a task sends one row of sums an entry, which Spark adds up, so the driver sees only codebooks.

Nearest entries are found as in a VA-file: each coordinate of a codebook's entries is quantised to a cell of 4 bits, which holds equally many entries, and a
cell keeps the least and greatest coordinate in it. A part has a table, for each coordinate and cell, of the least and greatest squared distance to the
cell; their sums over an entry's cells bound its distance from below and above. Only entries whose lower bound isn't above the least upper bound are refined,
with integers, so the result is that of all distances. Sums are taken for many parts at once, as a product of the tables with the entries' cells (zeros
and ones); they are rounded, so the comparison allows for more than their greatest error.

Rows whose vector is null, or holds null or non-finite components, are left out. So are vectors of another length than that of the smallest id (of its least
vector, if the id is repeated). A length that no four parts divide is filled up with zeros. Repeated rows each have their code and count in the means; a repeated
id starts one entry. A row with a null id is coded, but starts no entry; without any id there are no entries, and codes and errors are null. Ties go to the lower entry.
Null labels are one label. Fewer ids than entries make a smaller codebook; an empty table gives no rows. Components so large that a sum of squares or of components
could leave 64 bits (beyond some 180,000 in 64 dimensions) raise a ValueError. Other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import SENT, as_text, cut, longs, table, with_each

SCALE, PARTS, ENTRIES, ROUNDS, BITS = 1024, 4, 256, 4, 4
#: Bounds are sums of 32-bit floats; relative to the greatest of them their error stays far below this.
ALLOWED = 1e-4


class Cells:
    """The entries (k, w) of one codebook, with the cells of their coordinates."""

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries, (k, w) = entries, entries.shape
        n = min(1 << bits, k)
        rank = np.argsort(np.argsort(entries, axis=0, kind="stable"), axis=0, kind="stable")
        cell, column = rank * n // k, np.broadcast_to(np.arange(w), (k, w))
        self.low, self.high = np.full((n, w), np.iinfo(np.int64).max), np.full((n, w), np.iinfo(np.int64).min)
        np.minimum.at(self.low, (cell, column), entries)
        np.maximum.at(self.high, (cell, column), entries)
        self.held = np.zeros((n * w, k), np.float32)
        self.held[(cell * w + column).ravel(), np.repeat(np.arange(k), w)] = 1

    def candidates(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry), by row, of all entries that can be nearest to a row of parts (n, w)."""
        below, above = (self.low - parts[:, None]).astype(np.float32), (parts[:, None] - self.high).astype(np.float32)
        least, most = np.maximum(np.maximum(below, above), 0), np.maximum(-below, -above)
        lower = np.square(least).reshape(len(parts), -1) @ self.held
        upper = np.square(most).reshape(len(parts), -1) @ self.held
        return np.nonzero(lower <= upper.min(axis=1, keepdims=True) * np.float32(1 + ALLOWED))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, ties to the lower, and its squared distance."""
        row, entry = self.candidates(parts)
        distance = np.square(parts[row] - self.entries[entry]).sum(axis=1)
        best = np.minimum.reduceat(distance, np.flatnonzero(np.diff(row, prepend=-1)))
        at = np.flatnonzero(distance == best[row])
        return entry[at[np.flatnonzero(np.diff(row[at], prepend=-1))]], best


def integers(vectors: DataFrame, column: str = "embedding", parts: int = PARTS) -> DataFrame:
    """Written rows (vec_id, label as text, v) of the usable vectors, v of whole numbers; label is '' for null, else has a mark before it."""
    x = F.col(column)
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows = cut(vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v")), "vectors")
    first = rows.where("vec_id is not null").agg(F.min_by(F.size("v"), F.struct("vec_id", "v"))).first()[0]
    if first is not None:
        rows = rows.where(F.size("v") == first)
    if first and first % parts:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), -first % parts)))
    return rows


def _in_range(rows: DataFrame) -> None:
    n, width, low, high = rows.agg(F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    top = max(abs(low or 0), abs(high or 0)) + 1
    if width and max(width * (2 * top) ** 2, n * top) >= 1 << 63:
        raise ValueError(f"components up to {top / SCALE:.0f} are too large for whole-number distances of 64 bits")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64, copy=False)


def _sums(books: np.ndarray):
    """For each part position and entry that is nearest to any part of the task's rows: their sum and number."""
    k, width = books.shape[1:]

    def run(frames):
        cells = [Cells(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for f in frames:
            if len(f):
                v = _matrix(f.v)
                for p, c in enumerate(cells):
                    own = v[:, p * width : (p + 1) * width]
                    near, _ = c.nearest(own)
                    np.add.at(total[p], near, own)
                    count[p] += np.bincount(near, minlength=k)
        part, entry = np.nonzero(count)
        yield pd.DataFrame({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "sums": list(total[part, entry]), "n": count[part, entry]})

    return run


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (part, entry, component) after all rounds; of rows as `integers` gives them."""
    _in_range(rows)
    known = rows.where("vec_id is not null")
    ids = [r.vec_id for r in known.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    start = sorted(known.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("v").alias("v")).collect()) if ids else []
    if not start or not len(start[0].v):
        return np.zeros((parts, len(start), 0), np.int64)
    books = np.array([r.v for r in start], np.int64).reshape(len(start), parts, -1).swapaxes(0, 1)
    for _ in range(rounds):
        sums = rows.select("v").mapInPandas(_sums(books), "part int, entry int, sums array<long>, n long")
        totals = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(books.shape[2])]
        books = books.copy()
        for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():  # a row an entry
            books[r.part, r.entry] = np.array(r[3:], np.int64) // r.n
    return books


def _codes(books: np.ndarray):
    width = books.shape[2]

    def run(frames):
        cells = [Cells(b) for b in books]
        for f in frames:
            if not len(f):
                continue
            code, error = np.zeros((len(f), len(books)), np.uint8), np.zeros(len(f), np.int64)
            if width:
                v = _matrix(f.v)
                for p, c in enumerate(cells):
                    code[:, p], far = c.nearest(v[:, p * width : (p + 1) * width])
                    error += far
            yield pd.DataFrame({"vec_id": longs(f.vec_id), "label": f.label, "code": [c.tobytes() for c in code], "error": error})

    return run


def compress(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): a byte a part, and the squared distance to the entries. Up to 256 entries a codebook."""
    if not books.shape[1]:
        return rows.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return rows.select(as_text("vec_id"), "label", "v").mapInPandas(_codes(books), "vec_id long, label string, code binary, error long")


def decompress(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """codes with v, the vector of a code's entries."""

    def run(frames):
        for f in frames:
            code = np.array([list(c) for c in f.code], np.int64).reshape(len(f), len(books))
            yield pd.DataFrame({"vec_id": longs(f.vec_id), "v": list(np.concatenate([b[code[:, p]] for p, b in enumerate(books)], axis=1)) if len(f) else []})

    return codes.select(as_text("vec_id"), "code").where("code is not null").mapInPandas(run, "vec_id long, v array<long>")


def sha256_of(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integers(table(spark, sf_dir, "embeddings"))
    books = codebooks(rows)
    codes = cut(compress(rows, books), "codes")
    sums = cut(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    found = codes.join(F.broadcast(sums), "label") if sums.count() <= SENT else with_each(codes, sums, "label")
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(sha256_of(books)).alias("codebooks_sha256"))
