"""The jobs as registered queries, each run twice into a folder of its own, and their SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import training_tables, variant_feed
from tidemark.queries import NT_SQL, residue_sql
from tidemark.session import shared_folder


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark-job-{uuid.uuid4().hex}"


def job1_variant_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    top, config = _folder(spark), json.loads(variant_feed.CONFIG.read_text())
    for _ in range(2):
        found = variant_feed.run(spark, f"{sf_dir}/documents.parquet", f"{top}/out", f"{top}/checkpoint", config)
    return found.drop("through")


def job2_training_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    top, config = _folder(spark), json.loads(training_tables.CONFIG.read_text())
    for _ in range(2):
        found = training_tables.run(spark, sf_dir, f"{top}/out", config)
    return found


QUERIES = {"job1_variant_feed": job1_variant_feed, "job2_training_tables": job2_training_tables}
ORACLES = {
    "job1_variant_feed": f"""
SELECT dataset, replace(picked, '-', '') AS nt, aa, CAST(2015 + n_chars % 9 AS INT) AS year, CAST(1 + n_chars % 12 AS INT) AS month, count(*) AS n FROM (
SELECT coalesce(source, 'unknown') AS dataset, n_chars, picked, coalesce(array_to_string(list_transform(regexp_extract_all(picked, '...'), lambda c: CASE WHEN contains(c, '-') THEN '-' ELSE {residue_sql('c')} END), ''), '') AS aa
FROM (SELECT source, CASE WHEN lang IS NOT NULL AND source IS NOT NULL THEN n_chars END AS n_chars, concat(substr(s, 1, 15), substr(s, 31, 15)) AS picked FROM (SELECT source, lang, n_chars, {NT_SQL} AS s FROM documents)))
WHERE length(regexp_replace(aa, '[-X*]', '', 'g')) >= 0.9 * 10 GROUP BY ALL""",
    "job2_training_tables": """
WITH seen AS (SELECT l_partkey AS k, strftime(l_shipdate, '%Y-%m') AS bin, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY ALL),
v AS (SELECT p_partkey AS k, p_type AS g, p_brand AS m, CAST(p_size AS VARCHAR) AS nt, upper(replace(p_name, ' ', '-')) AS aa, concat(p_type, '_', p_brand, '_', p_size % 3) AS benchmark FROM part),
found AS (SELECT g, m, nt, aa, CASE WHEN CAST(substr(bin, 1, 4) AS INT) BETWEEN 1997 AND 2100 THEN bin ELSE 'unknown' END AS bin, CAST(sum(n) AS BIGINT) AS n FROM seen JOIN v USING (k) WHERE aa <> '' GROUP BY ALL),
kept AS (SELECT *, CAST(sum(n) OVER (PARTITION BY g, m, nt, aa) AS BIGINT) AS total FROM found WHERE 10 * length(regexp_replace(aa, '[^-X]', '', 'g')) <= length(aa))
SELECT benchmark, nt, aa, bin, n, total FROM kept JOIN (SELECT DISTINCT g, m, benchmark FROM v) USING (g, m)""",
}
