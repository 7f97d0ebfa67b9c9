import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, invented
from tidemark.llm import sharding


def sized(text):
    return len((text or "").encode()) + 1


def check(rows, docs, shards):
    """All rows are there, groups are whole, slots gapless and by doc_id."""
    by_shard, of = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r)
        of[r.text or ""].add(r.shard)
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((r.doc_id, r.text) for r in docs), key=repr)
    assert all(len(s) == 1 for s in of.values()) and set(by_shard) <= set(range(shards))
    for held in by_shard.values():
        held.sort(key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        ids = [r.doc_id for r in held]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    return [sum(sized(r.text) for r in by_shard[s]) for s in range(shards)]


@pytest.mark.parametrize("file_bytes", [3_000, 1 << 28])
def test_small_items_are_placed_as_by_one_heap(spark, corpus, tmp_path, file_bytes):
    """Where each group is an item of its own, the shards are those of plain longest-processing-time scheduling."""
    docs = corpus.select("doc_id", "text", "source").repartition(5)
    found = sharding.write_shards(docs, f"file://{tmp_path}/x", 4, 10**6, file_bytes)
    rows = sharding.read_shards(spark, found).collect()
    check(rows, corpus.collect(), 4)
    groups = {r.g: 0 for r in corpus.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("g")).collect()}
    for r in corpus.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("g")).collect():
        groups[r.g] += sized(r.text)
    loads, want = [0] * 4, {}
    for g in sorted(groups, key=lambda g: (-groups[g], g)):
        want[g] = min(range(4), key=lambda s: (loads[s], s))
        loads[want[g]] += groups[g]
    got = {r.g: r.shard for r in sharding.read_shards(spark, found).select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("g"), "shard").collect()}
    assert got == want


def test_many_small_groups_and_a_hot_one(spark, tmp_path):
    rng = random.Random(4)
    texts = [invented(rng, rng.randint(1, 30)) for _ in range(6_000)] + ["one text of many copies"] * 1_000 + [invented(rng, 3_000)]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for units in (1, 16, 256):
        found = sharding.write_shards(docs, f"file://{tmp_path}/{units}", 8, units, 40_000)
        loads = check(sharding.read_shards(spark, found).collect(), docs.collect(), 8)
        assert (max(loads) - min(loads)) * (8 * units if units > 1 else 4) <= 2 * sum(loads)


def test_a_group_above_a_share_gets_a_shard(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 500 if i % 2 else f"own {i:05}") for i in range(400)], "doc_id long, text string")
    loads = check(sharding.read_shards(spark, sharding.write_shards(docs, f"file://{tmp_path}/x", 4)).collect(), docs.collect(), 4)
    assert max(loads) == 200 * 501 and len(set(sorted(loads)[:3])) <= 2


def test_empty_and_clashing(spark, empty, tmp_path):
    assert sharding.read_shards(spark, sharding.write_shards(empty, f"file://{tmp_path}/none")).collect() == []
    names = ("shard", "slot", "place", "_g", "_b", "_own", "_tie", "_group", "rows", "first", "range", "size")
    docs = spark.createDataFrame([(1, "a", *names), (None, None, *names), (1, "a", *names)], "doc_id long, text string, " + ", ".join(f"{x} string" for x in names))
    rows = sharding.read_shards(spark, sharding.write_shards(docs, f"file://{tmp_path}/c", 2)).collect()
    assert len(rows) == 3 and all(r[x] == x for r in rows for x in names)
    assert sorted((r.shard_, r.slot_) for r in rows) == [(0, 0), (0, 1), (1, 0)]


def test_query(spark, corpus, tmp_path):
    corpus.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = sharding.op12_sharding(spark, str(tmp_path)).collect()
    want = sorted(((r.doc_id, sized(r.text), zlib.crc32((r.text or "").encode())) for r in corpus.collect()), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)} and len({(r.shard, r.slot) for r in rows}) == len(rows)
