"""Brings the texts of linked documents together, so that each candidate pair is looked at once.

A document with many candidates (a hub) is met by them in blocks of bounded size; no task has to hold a whole group."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shared
from tidemark.llm.shared import cut, let_go, small, trimmed

BLOCK = 64


def with_texts(pairs: DataFrame, docs: DataFrame, judge, schema: str, noted: bool = True) -> DataFrame:
    """pairs: hub, member (long) and note (binary or null), one row per pair. docs: doc_id, text.

    judge(hub_text) returns a function (hub, member, member_text, note) -> iterable of rows of `schema`. A pair of which
    one id has no row in docs gives nothing; of repeated ids any row serves."""
    crowd = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    pairs = pairs.join(crowd, "hub").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")))
    needs = pairs.select(F.col("member").alias("id"), "hub", "block", F.lit(1).alias("role"), "note").unionByName(
        pairs.select(F.col("hub").alias("id"), "hub", "block", F.lit(0).alias("role"), F.lit(None).cast("binary").alias("note")).distinct()
    )
    if not noted:
        needs = small(cut(needs, "needs"))
    docs = docs.select(F.col("doc_id").alias("id"), "text")
    if noted:
        ids = cut(needs.select("id").distinct(), "ids")
        docs = docs.join(F.broadcast(ids), "id", "left_semi") if ids.count() <= shared.SENT else docs
    rows = docs.join(needs, "id")
    rows = rows.repartition("hub", "block").sortWithinPartitions("hub", "block", "role", "id")

    def run(frames):
        let_go()
        at = look = None
        for f in frames:
            out = []
            for hub, block, role, member, note, text in zip(f.hub, f.block, f.role, f.id, f.note, f.text, strict=True):
                if at != (hub, block):
                    at, look = (hub, block), judge(text) if role == 0 else None
                elif role and look:
                    out += look(hub, member, text, note)
            if out:
                yield pd.DataFrame(out, columns=names)

    names = [x.split()[0] for x in schema.split(",")]
    return rows.select("hub", "block", "role", "id", "note", "text").mapInPandas(trimmed(run), schema)
