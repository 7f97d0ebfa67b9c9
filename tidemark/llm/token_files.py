"""Token-ID files with shuffled bit planes.

A file holds the documents of one range of doc_id, ascending: blocks of BLOCK ids, a document table, a chunk index and a
footer. A block's ids are transposed into bit planes (as many as its largest id has bits), each compressed by zstandard on
its own; the index has, for each block, its place, its number of ids and the sizes of its planes, so that any block can be
read alone. All numbers are little-endian.

    magic | block: planes... | block ... | doc ids <i8 | known <u1 | lengths <u8 (each zstd) | chunk index (zstd) | footer

Writing: ranges come from approximate quantiles of doc_id (an id with very many rows, or none, is split by its rows' checksums), ids are shuffled to
their range and sorted, each task streams its files to the shared folder. Each attempt of a task writes files of names of its own, and the list of files
names those of the attempts that succeeded, so a lost task is just run again. Reading goes through Spark's reader of whole files, and takes
all numbers from the files. Rows with a null doc_id come first; rows with the same doc_id are ordered by their ids' checksum, repeated rows are kept. A null or empty
text is empty (only the end id), very long texts span blocks, an empty table writes no file. Other columns are ignored."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.packing import framed, narrow, wide, with_bases
from tidemark.llm.shared import Ranges, about_chars, as_text, cut, new_path, small, table, trimmed
from tidemark.llm.tokens import encoder

MAGIC, END, BLOCK = b"TMPLANE1", 2, 65_536
FOOTER = struct.Struct("<qqqqqqqq8s")
#: Characters of text that go to a file, about.
FILE_CHARS = 12_000_000
SUFFIX = ".planes"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Bit planes of up to BLOCK ids, lowest first; none if all ids are 0."""
    bits = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(p, bitorder="little").tobytes() for p in bits.T[: int(ids.max(initial=0)).bit_length()]]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    bits = np.zeros((32, n), np.uint8)
    for k, p in enumerate(planes):
        bits[k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u4").ravel()


class PlaneWriter:
    """Streams documents into one file."""

    def __init__(self, sink, level: int = 1):
        import zstandard

        self.sink, self.zip = sink, zstandard.ZstdCompressor(level=level)
        self.at, self.held, self.n, self.index, self.docs = 0, [], 0, [], []
        self._put(MAGIC)

    def _put(self, raw: bytes) -> int:
        self.sink.write(raw)
        self.at += len(raw)
        return len(raw)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc or 0, doc is not None, len(ids)))
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= 4 * BLOCK:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        to = len(ids) if last else len(ids) - len(ids) % BLOCK
        for x in range(0, to, BLOCK):
            block = ids[x : min(x + BLOCK, to)]
            at = self.at
            sizes = [self._put(self.zip.compress(p)) for p in to_planes(block)]
            self.index.append([at, len(block), *sizes, *[0] * (32 - len(sizes))])
        self.held, self.n = [ids[to:]], len(ids) - to

    def close(self) -> int:
        self._blocks(True)
        total = sum(n for _, _, n in self.docs)
        places = []
        for k, kind in enumerate(("<i8", "<u1", "<u8")):
            places.append(self.at)
            self._put(self.zip.compress(np.array([d[k] for d in self.docs], kind).tobytes()))
        places.append(self.at)
        self._put(self.zip.compress(np.array(self.index, "<i8").tobytes()))
        self._put(FOOTER.pack(*places, self.at, len(self.docs), total, len(self.index), MAGIC))
        return total


class PlaneReader:
    """Reads a file's bytes; `ids(k)` decodes one block, `documents()` all of them in turn."""

    def __init__(self, raw):
        import zstandard

        self.raw, self.zip = memoryview(raw), zstandard.ZstdDecompressor()
        *places, end, docs, self.total, blocks, magic = FOOTER.unpack(self.raw[-FOOTER.size :])
        if bytes(self.raw[:8]) != MAGIC or magic != MAGIC:
            raise ValueError("not a file of bit planes")
        part = [self.zip.decompress(self.raw[a:b]) for a, b in zip(places, [*places[1:], end], strict=True)]
        self.doc_ids, self.known, self.lengths = (np.frombuffer(p, k) for p, k in zip(part, ("<i8", "<u1", "<u8"), strict=False))
        self.index = np.frombuffer(part[3], "<i8").reshape(blocks, 34)

    def ids(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index[k].tolist()
        planes = []
        for s in filter(None, sizes):
            planes.append(self.zip.decompress(self.raw[at : at + s]))
            at += s
        return from_planes(planes, n)

    def documents(self):
        """(doc_id or None, place in this file, ids)"""
        held, k, at = np.zeros(0, np.uint32), 0, 0
        for doc, known, n in zip(self.doc_ids.tolist(), self.known.tolist(), self.lengths.tolist(), strict=True):
            if len(held) < n:
                more = [held]
                while sum(map(len, more)) < n:
                    more.append(self.ids(k))
                    k += 1
                held = np.concatenate(more)
            yield doc if known else None, at, held[:n]
            held, at = held[n:], at + n


def _encode(path, end, ranges):
    def run(frames):
        coder = encoder(path)
        for f in frames:
            docs, rows = f.doc_id.tolist(), []
            for doc, raw in zip(docs, coder.encode(f.text), strict=True):
                ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end))
                rows.append([0, doc, zlib.crc32(ids.tobytes()), len(ids), (ids.astype("<u2") if narrow(ids) else ids).tobytes()])
            known = np.array([d is not None for d in docs], bool)
            part = ranges.of(np.array([int(d) if d is not None else 0 for d in docs], np.int64), known, np.array([r[2] for r in rows]) / (1 << 32))
            for r, p in zip(rows, part.tolist(), strict=True):
                r[0] = p
            yield framed(rows, ["part", "doc_id", "tie", "n", "ids"])

    return run


def _write(folder):
    def run(frames):
        from pyarrow.fs import FileSystem

        fs, top = FileSystem.from_uri(folder)
        fs.create_dir(top, recursive=True)
        part = writer = sink = name = None

        def close():
            total = writer.close()
            sink.close()
            return part, name, len(writer.docs), total

        for f in frames:
            done = []
            for p, doc, n, raw in zip(f.part.tolist(), f.doc_id.tolist(), f.n.tolist(), f.ids, strict=True):
                if p != part:
                    if writer:
                        done.append(close())
                    part, name = p, f"part-{p:08d}-{uuid.uuid4().hex}{SUFFIX}"
                    sink = fs.open_output_stream(f"{top}/{name}")
                    writer = PlaneWriter(sink)
                writer.add(None if doc is None else int(doc), wide(raw, n))
            if done:
                yield pd.DataFrame(done, columns=COLUMNS)
        if writer:
            yield pd.DataFrame([close()], columns=COLUMNS)

    return run


COLUMNS = ["part", "name", "docs", "n"]


def _read(frames):
    for f in frames:
        for part, raw in zip(f.part.tolist(), f.content, strict=True):
            reader = PlaneReader(raw)
            rows = [(part, doc, at, len(ids), zlib.crc32(ids.tobytes())) for doc, at, ids in reader.documents()]
            if sum(r[3] for r in rows) != reader.total:
                raise ValueError(f"file {part} doesn't hold what its footer says")
            yield framed(rows, ["part", "doc_id", "at", "n_tokens", "ids_crc32"])


def write_files(docs: DataFrame, folder: str, end: int = END, path: str | None = None, file_chars: int = FILE_CHARS) -> DataFrame:
    """Writes docs (doc_id, text) to files in folder; returns the list of the files that count: part, name, docs, n (ids)."""
    ranges = Ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id")), files := max(1, about_chars(docs) // file_chars))
    docs = docs.select(as_text("doc_id"), "text")
    ids = docs.mapInPandas(trimmed(_encode(path, end, ranges)), "part long, doc_id long, tie long, n long, ids binary")
    ids = ids.repartition(files, "part").sortWithinPartitions("part", "doc_id", "tie")
    ids = ids.withColumn("doc_id", F.col("doc_id").cast("string"))
    return cut(ids.mapInPandas(trimmed(_write(folder)), "part long, name string, docs long, n long"), "files")


def read_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, all from the files' bytes; files: which of the folder's count."""
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select(F.substring_index("path", "/", -1).alias("name"), "content")
    raw = raw.join(small(files.select("name", "part")), "name").select("part", "content")
    rows = cut(raw.mapInPandas(trimmed(_read), "part long, doc_id long, at long, n_tokens long, ids_crc32 long"), "tokens")
    return with_bases(rows, rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    return read_files(spark, folder, write_files(table(spark, sf_dir, "documents"), folder))
