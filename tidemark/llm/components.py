"""Connected components of a link table, without collecting it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

#: Link tables up to this many rows are contracted by one task (about 100 MB); longer ones by rounds of joins.
ONE_TASK = 2_000_000


def contract(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and smallest node of its component, for the (n, 2) int64 links; rounds of hooking and pointer jumping."""
    nodes, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(-1, 2)
    top = np.arange(len(nodes))
    while True:
        a, b = top[at[:, 0]], top[at[:, 1]]
        if (a == b).all():
            return nodes, nodes[top]
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        while (top != top[top]).any():
            top = top[top]


def _forest(frames):
    held = [f[["a", "b"]].to_numpy(np.int64) for f in frames]
    if held and sum(map(len, held)):
        node, low = contract(np.concatenate(held))
        keep = node != low
        yield pd.DataFrame({"a": low[keep], "b": node[keep]})


def _labels(frames):
    held = [f[["a", "b"]].to_numpy(np.int64) for f in frames]
    if held and sum(map(len, held)):
        node, low = contract(np.concatenate(held))
        yield pd.DataFrame({"node": node, "component": low})


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): component is the smallest node reachable. links: columns a, b (long, not null); loops and repeats are fine.

    An empty table gives an empty table. Each partition is first reduced to a spanning forest. If little is left, one task
    finishes; else large-star and small-star steps alternate, each a shuffled minimum and a join, written to the shared folder."""
    links = cut(links.select("a", "b").where("a <> b").repartition("a", "b").mapInPandas(_forest, "a long, b long"), "links")
    rounds = 0
    while (n := links.count()) > one_task:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        large = cut(large, "large")
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(low, large.b == low.u).select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y").distinct()
        small = cut(small.select(F.col("x").alias("a"), F.col("y").alias("b")), "small")
        same = small.exceptAll(links).isEmpty() and small.count() == n
        links, rounds = small, rounds + 1
        if same:
            return links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).unionByName(
                links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    return links.coalesce(1).mapInPandas(_labels, "node long, component long")
