"""Sharding by longest processing time: groups that must stay together, largest first, each to the shard that holds least.

Rows of equal texts are a group (a 64-bit hash tells texts apart; two texts of one hash would only share a shard). Sizes of groups are
summed in Spark, map-side first. A group above 1 / (256 * shards) of all bytes is an item of its own, of which there are fewer than
256 * shards whatever the input; all smaller groups, whole, are bundled by hash into as many further items. So the heap sees 512 * shards
items at most, and since it places the smallest last, shards differ by about the smallest of them, if no group exceeds a shard's share.
The items' shards are sent to the rows (a bounded table). Rows are ranged by shard and doc_id and written as Parquet, a folder a shard;
an index of the ranges (one row a range and shard) gives each row its slot, 0 and on in its shard, by doc_id.

A null text has no bytes and is grouped with empty ones. Rows with repeated or null doc_id (first in their shard) are rows like others;
ties are in the order of the text's hash, then of the input. Other columns are kept; names that clash get an underscore. An empty
table gives no rows."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.shared import cut, free_name, new_path, table

SHARDS, UNITS = 16, 256
#: About so many bytes of text are in a range, hence in a file.
FILE_BYTES = 1 << 28
#: A row's place holds its range above these bits, and its number in the range below.
BITS = 33


def longest_first(items: list[tuple[int, object]], shards: int) -> list[int]:
    """The shard of each (size, key): by size, largest first, ties by key, each to the least loaded shard, ties to the lowest."""
    heap, out = [(0, s) for s in range(shards)], [0] * len(items)
    for k in sorted(range(len(items)), key=lambda k: (-items[k][0], items[k][1])):
        load, out[k] = heap[0]
        heapq.heapreplace(heap, (load + items[k][0], out[k]))
    return out


def size_of(text: str = "text"):
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def with_shards(docs: DataFrame, column: str, group: str, shards: int = SHARDS, units: int = UNITS) -> tuple[DataFrame, int]:
    """docs with a column of shards and one of the groups' hashes, and the bytes of all."""
    spark, n = docs.sparkSession, shards * units
    docs = docs.withColumn(group, F.xxhash64(F.coalesce("text", F.lit(""))))
    groups = cut(docs.select(F.col(group).alias("g"), size_of().alias("size")).groupBy("g").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    alone, bundle = F.col("size") > total // n, F.pmod("g", F.lit(n))
    items = groups.groupBy(F.when(alone, F.col("g")).alias("g"), F.when(~alone, bundle).alias("b")).agg(F.sum("size").alias("size")).collect()
    of = longest_first([(r["size"], (r.g is None, r.b if r.g is None else r.g)) for r in items], shards)
    names = {x: free_name(docs, f"_{x}") for x in ("g", "b", "own", "shared")}
    own = spark.createDataFrame([(r.g, s) for r, s in zip(items, of, strict=True) if r.g is not None], f"{names['g']} long, {names['own']} int")
    shared = spark.createDataFrame([(r.b, s) for r, s in zip(items, of, strict=True) if r.g is None], f"{names['b']} long, {names['shared']} int")
    rows = docs.join(F.broadcast(own), F.col(group) == F.col(names["g"]), "left").join(F.broadcast(shared), F.pmod(group, F.lit(n)) == F.col(names["b"]), "left")
    return rows.withColumn(column, F.coalesce(names["own"], names["shared"])).drop(*names.values()), total


@dataclass
class Shards:
    """Written shards: the folder of the rows, that of the index, and what the rows hold."""

    rows: str
    index: str
    schema: StructType
    shard: str
    place: str


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, units: int = UNITS, file_bytes: int = FILE_BYTES) -> Shards:
    """Writes all rows and columns of docs below path, a folder a shard. Lost tasks leave no file that counts."""
    shard, group, tie, place = (free_name(docs, x) for x in ("shard", "_group", "_tie", "place"))
    rows, total = with_shards(docs.withColumn(tie, F.monotonically_increasing_id()), shard, group, shards, units)
    order = [shard, "doc_id", group, tie]
    rows = rows.repartitionByRange(max(shards, -(-total // file_bytes)), *order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    out = Shards(f"{path}/rows", f"{path}/index", rows.select(*docs.columns, place, shard).schema, shard, place)
    rows.select(*docs.columns, place, shard).write.partitionBy(shard).parquet(out.rows)
    spans = _rows(docs.sparkSession, out).groupBy(F.shiftright(place, BITS).alias("range"), F.col(shard).alias("shard")).agg(F.min(place).alias("first"), F.count("*").alias("rows"))
    slots = F.sum("rows").over(W.partitionBy("shard").orderBy("range")) - F.col("rows")  # a range or two a row
    spans.select("range", "shard", "first", "rows", slots.alias("slot")).write.parquet(out.index)
    return out


def _rows(spark: SparkSession, at: Shards) -> DataFrame:
    return spark.read.schema(at.schema).parquet(at.rows)


def read_shards(spark: SparkSession, at: Shards) -> DataFrame:
    """The rows of the files, with their shard and, in place of the place, their slot."""
    index = spark.read.schema("range long, shard int, first long, rows long, slot long").parquet(at.index)
    rows, slot = _rows(spark, at), free_name(_rows(spark, at), "slot")
    names = {x: free_name(rows, f"_{x}") for x in index.columns}
    index = index.withColumnsRenamed(names)
    found = rows.join(F.broadcast(index), (F.shiftright(at.place, BITS) == F.col(names["range"])) & (F.col(at.shard) == F.col(names["shard"])))
    return found.withColumn(slot, F.col(at.place) - F.col(names["first"]) + F.col(names["slot"])).drop(at.place, *names.values())


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = read_shards(spark, write_shards(docs, new_path(spark, "shards")))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return rows.select("doc_id", size_of().alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
