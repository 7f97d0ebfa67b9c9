import math
import random

import numpy as np
import pytest

from tidemark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """All distances, one by one."""
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(y is not None and math.isfinite(y) for y in v)]
    kept = [(i, [math.floor(1024 * float(np.float32(y))) for y in v], x) for i, v, x in kept]
    width = len(min((i, v) for i, v, _ in kept if i is not None)[1])
    kept = [(i, v + [0] * (-width % parts), x) for i, v, x in kept if len(v) == width]
    first = {}
    for i, v, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    w = len(kept[0][1]) // parts
    books = [[first[i][p * w : p * w + w] for i in sorted(first)[:entries]] for p in range(parts)]

    def near(q, book):
        far = [sum((a - b) ** 2 for a, b in zip(q, e, strict=True)) for e in book]
        return min(range(len(book)), key=lambda k: (far[k], k)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                q = v[p * w : p * w + w]
                own[near(q, books[p])[0]].append(q)
            books[p] = [[sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)]
    out = []
    for i, v, x in kept:
        found = [near(v[p * w : p * w + w], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for k, _ in found), sum(d for _, d in found), x))
    sums = {x: sum(e for _, _, e, y in out if y == x) for x in {o[3] for o in out}}
    return sorted(((i, c, e, sums[x]) for i, c, e, x in out), key=repr), vector_codes.sha256_of(np.array(books))


def run(spark, tmp_path, rows, schema=SCHEMA):
    path = f"{tmp_path}/{random.random()}"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    got = vector_codes.op11_vector_codes(spark, path).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr), {r.codebooks_sha256 for r in got}


def invented(rng, n, width, spread=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i * 7 % n, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]


@pytest.mark.parametrize(("n", "width"), [(420, 16), (300, 6), (40, 8), (3, 4)])
def test_equals_all_distances(spark, tmp_path, n, width):
    rng = random.Random(n)
    rows = invented(rng, n, width)
    bad = [(n, None, 1), (n + 1, [float("nan")] * width, 1), (n + 2, [None] + [0.0] * (width - 1), 2), (-1, [float("-inf")] * width, 1), (n + 3, [0.1] * (width + 1), 1), (n + 4, [], 3)]
    more = [rows[0], rows[0], (rows[1][0], [9.0] * width, 2), (None, [0.25] * width, None), (n + 5, [0.0] * width, 3), (n + 6, [0.0] * width, 3)]
    got, sha = run(spark, tmp_path, rows + bad + more)
    want, want_sha = plain(rows + bad + more)
    assert got == want and sha == {want_sha}


def test_ties_and_coarse_grids(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 0, 0.5, 1]) / 8 for _ in range(12)], i % 2) for i in range(500)]
    got, sha = run(spark, tmp_path, rows)
    want, want_sha = plain(rows)
    assert got == want and sha == {want_sha}


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    for scale, k, w in ((300, 256, 16), (3, 256, 16), (10**7, 200, 5), (10**8, 7, 3), (0, 4, 2)):
        entries, parts = (rng.normal(0, scale, (n, w)).astype(np.int64) for n in (k, 300))
        cells = vector_codes.Cells(entries)
        far = np.square(parts[:, None] - entries[None]).sum(axis=2)
        near, distance = cells.nearest(parts)
        assert (near == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
        if scale == 300:
            assert len(cells.candidates(parts)[0]) < 0.3 * far.size


def test_no_rows_no_ids_and_other_columns(spark, tmp_path):
    assert run(spark, tmp_path, []) == ([], set())
    assert run(spark, tmp_path, [(1, None, 1)])[0] == []
    assert run(spark, tmp_path, [(None, [0.5, 0.5], None)])[0] == [(None, None, None, None)]
    assert run(spark, tmp_path, [(4, [], 1), (5, [], 1)])[0] == [(4, "00000000", 0, 0), (5, "00000000", 0, 0)]
    wide = [(i, [i / 9, 0.0, 0.5, 1.0], i % 2, "x", 3) for i in range(9)]
    got, sha = run(spark, tmp_path, wide, SCHEMA + ", code string, error long")
    assert (got, *sha) == plain([r[:3] for r in wide])
    with pytest.raises(ValueError):
        run(spark, tmp_path, [(1, [1e30, 0.0, 0.0, 0.0], 1)])


def test_round_trip_is_the_error(spark, tmp_path):
    rows = spark.createDataFrame(invented(random.Random(8), 300, 8), SCHEMA)
    whole = vector_codes.integers(rows)
    books = vector_codes.codebooks(whole, entries=16)
    codes = vector_codes.compress(whole, books)
    back = {r.vec_id: np.array(r.v) for r in vector_codes.decompress(codes, books).collect()}
    given = {r.vec_id: np.array(r.v) for r in whole.collect()}
    assert {r.vec_id: r.error for r in codes.collect()} == {i: int(np.square(back[i] - v).sum()) for i, v in given.items()}
