import random
import zlib

import numpy as np
import pandas as pd
import pytest

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import packing, token_files, tokens

pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers")
ODD = "aAbZ éÉßİıΣςσ'’“”–.,;!?\n\t\r  ́̈e1２³½3-_µªº<|>ДжЖ中文😀​\x1c\x85ﬁŸŽžʰŉDž"
PARTS = [*ODD, "<|endoftext|>", "<|startoftext|>", "don't", "it's", "we'll've", "''s", "!'s", " ", "  ", " "]


def plain(texts):
    inner = tokens.encoder().inner
    return [np.array(e.ids, "<u4").tobytes() for e in inner.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_library_s():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(4000)] + [invented(rng, 500), "x" * 5000, "", "DON'T"]
    assert tokens.encoder().encode(texts) == plain(texts)
    small = tokens.Encoder(remembered=16)
    assert small.encode(texts[:500]) == plain(texts[:500]) and small.encode([None, "a"]) == plain(["", "a"])
    assert tokens.Encoder(split=False).encode(texts[:50]) == plain(texts[:50])


def expected(corpus, end):
    rows = [(r.doc_id, r.text or "") for r in corpus.select("doc_id", "text").collect()]
    return [(d, [*np.frombuffer(i, "<u4").tolist(), end]) for (d, _), i in zip(rows, plain([t for _, t in rows]), strict=True)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("file_chars", [5_000, 10**9])
def test_files_round_trip(corpus, spark, tmp_path, file_chars):
    files = token_files.write_files(corpus.repartition(7), f"file://{tmp_path}/ids", file_chars=file_chars)
    got = token_files.read_files(spark, f"file://{tmp_path}/ids", files).collect()
    want = sorted(expected(corpus, token_files.END), key=lambda x: (x[0] is not None, x[0] or 0, crc(x[1])))
    at, rows = 0, []
    for d, ids in want:
        rows.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == rows
    assert sorted(p.name for p in (tmp_path / "ids").glob("*.planes")) == sorted(r.name for r in files.collect())
    (tmp_path / "ids/part-00000000-lost.planes").write_bytes(b"half a file of a lost task")
    assert sorted(map(tuple, token_files.read_files(spark, f"file://{tmp_path}/ids", files).collect()), key=lambda r: r[1]) == rows


def test_no_documents(empty, spark, tmp_path):
    files = token_files.write_files(empty, f"file://{tmp_path}/none")
    assert token_files.read_files(spark, f"file://{tmp_path}/none", files).collect() == []
    assert packing.packed(empty).collect() == []


def test_planes():
    rng = np.random.default_rng(3)
    for top in (1, 2, 300, 49_408, 1 << 32):
        ids = rng.integers(0, top, int(rng.integers(0, 5000)), dtype=np.uint64).astype("<u4")
        planes = token_files.to_planes(ids)
        assert (token_files.from_planes(planes, len(ids)) == ids).all() and len(planes) <= 32
    sink = __import__("io").BytesIO()
    writer = token_files.PlaneWriter(sink)
    docs = [(k if k % 3 else None, rng.integers(0, 50_000, int(rng.integers(0, 90_000))).astype(np.uint32)) for k in range(12)]
    for d, ids in docs:
        writer.add(d, ids)
    assert writer.close() == sum(len(i) for _, i in docs)
    reader = token_files.PlaneReader(sink.getvalue())
    assert [(d, i.tolist()) for d, _, i in reader.documents()] == [(d, i.tolist()) for d, i in docs]
    whole = np.concatenate([i for _, i in docs])
    assert (reader.ids(1) == whole[token_files.BLOCK : 2 * token_files.BLOCK]).all()
    with pytest.raises(ValueError):
        token_files.PlaneReader(b"x" * 200)


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(corpus, length):
    got = pd.DataFrame([r.asDict() for r in packing.packed(corpus.repartition(5), length).collect()])
    want = expected(corpus, packing.END)
    assert got.length.sum() == sum(len(i) for _, i in want) and (got.length > 0).all()
    per = got.groupby("sequence_id").length.sum().sort_index()
    assert (per[:-1] == length).all() and per.iloc[-1] <= length and per.index.tolist() == list(range(len(per)))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    by = {}
    for d, ids in want:
        by.setdefault(d, []).append(ids)
    for r in got.itertuples():
        d = None if pd.isna(r.doc_id) else int(r.doc_id)
        assert any(len(ids) == r.doc_tokens and crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for ids in by[d])
    one = got[got.doc_id == 0].sort_values("start")
    assert one.start.tolist() == [0, *np.cumsum(one.length)[:-1]]


def test_large_ids_stay_exact(spark):
    big = (1 << 62) + 1
    docs = spark.createDataFrame([(big, "a b", None, None, None), (None, "c", None, None, None), (big + 1, "", None, None, None)], SCHEMA).coalesce(1)
    assert {r.doc_id for r in packing.packed(docs).collect()} == {big, big + 1, None}


def test_long_groups_and_growing_table():
    x, y = "a", "b"
    for _ in range(11):
        x, y = x + y, y + x
    rng = random.Random(4)
    texts = [x, y, f"{x} {y}", y.upper(), *(invented(rng, 3000) for _ in range(6))]
    assert tokens.encoder().encode(texts) == plain(texts)
    first = tokens.Encoder(remembered=1 << 14)
    first.at_first = 64
    first._forget()
    for t in texts:
        assert first.encode([t]) == plain([t])
    assert first.room >= first.n


def test_hot_ids_are_split(spark):
    from tidemark.llm.shared import Ranges

    for seed in range(3):
        rng = random.Random(seed)
        ids = [rng.choice([*[None] * (3 * seed), *[5] * (9 * seed), -(1 << 63), (1 << 63) - 1, *range(-20, 40)]) for _ in range(900)]
        r = Ranges(spark.createDataFrame([(i,) for i in ids], "doc_id long"), 12)
        rows = sorted(((i, rng.random()) for i in ids), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        part = r.of(np.array([i or 0 for i, _ in rows], np.int64), np.array([i is not None for i, _ in rows]), np.array([t for _, t in rows]))
        assert (np.diff(part) >= 0).all() and np.bincount(part).max() < 300
    assert Ranges(spark.createDataFrame([], "doc_id long"), 5).of(np.zeros(2, np.int64), np.array([True, False]), np.zeros(2)).tolist() == [0, 0]
