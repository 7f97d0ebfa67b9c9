"""Registered queries of this subpackage, by number of the operator, and their SQL.

The n-gram join and the vector codes can be stated in SQL; the others are tested against a brute-force twin, a round trip or held-out
accuracy in tests/llm."""

from tidemark.llm.decontamination import op5_benchmark_decontamination
from tidemark.llm.fingerprints import op7_fingerprints
from tidemark.llm.html_text import op9_html_text
from tidemark.llm.language_id import op6_language_id
from tidemark.llm.ngram_join import op3_ngram_jaccard_join
from tidemark.llm.packing import op10_packing
from tidemark.llm.quality import op8_quality
from tidemark.llm.sharding import op12_sharding
from tidemark.llm.substring_dedup import op2_substring_dedup
from tidemark.llm.token_files import op4_token_files
from tidemark.llm.toxicity import op1_toxicity
from tidemark.llm.vector_codes import op11_vector_codes

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_token_files": op4_token_files,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_language_id": op6_language_id,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_sharding": op12_sharding,
}


def _vector_codes() -> str:
    """All distances of all parts to all entries, in each of the rounds."""
    near = "SELECT vec_id, part, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT p.vec_id, p.part, b.e, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{k} b ON b.part = p.part) GROUP BY ALL"
    mean = "SELECT part, e, list(m ORDER BY pos) AS v FROM (SELECT part, e, pos, (s - ((s % n) + n) % n) // n AS m FROM (SELECT a.part, a.e, u.pos, sum(p.v[u.pos])::BIGINT AS s, count(*) AS n FROM a{k} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part, (SELECT unnest(range(1, 17)) AS pos) u GROUP BY ALL)) GROUP BY ALL"
    rounds = "".join(
        f", a{k} AS MATERIALIZED ({near.format(k=k)}), m{k} AS ({mean.format(k=k)}), b{k + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.e = b.e)" for k in range(4))
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, v[part * 16 + 1 : part * 16 + 16] AS v FROM kept, (SELECT unnest(range(4)) AS part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, v FROM p QUALIFY e < 256){rounds},
f AS MATERIALIZED ({near.format(k=4)}),
c AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM f GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS h FROM b4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM c JOIN kept USING (vec_id), s
"""


ORACLES = {"op3_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS doc, a AS seen FROM ways UNION SELECT r.doc, ways.b FROM r JOIN ways ON ways.a = r.seen)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc, min(seen) AS m FROM r GROUP BY doc) c ON c.doc = d.doc_id
""",
    "op11_vector_codes": _vector_codes(),
}
