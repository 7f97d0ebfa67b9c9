"""Registered queries of the engine over the driver's tables, and their SQL twins.

The tables stand in for sequence data: texts become nucleotides by a letter map, order attributes become variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences, texts
from tidemark.operators import align, coding, counts, coverage, motif, profile
from tidemark.plans import registry, routing, schedule
from tidemark.streaming import incremental

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark, sf_dir) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    return o.select(F.col("o_orderstatus").alias("nt"), F.col("o_orderpriority").alias("aa"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def lines(spark, sf_dir) -> DataFrame:
    x = t(spark, sf_dir, "lineitem")
    return x.select(F.col("l_returnflag").alias("nt"), F.col("l_linestatus").alias("aa"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))


#: How a text is read as nucleotides.
MAP = ("aeiotnshrl", "ACGTACGTAN")
NT_SQL = f"regexp_replace(translate(lower(coalesce(text, '')), '{MAP[0]}', '{MAP[1]}'), '[^ACGTN]', '', 'g')"


def nucleotides(text: str = "text"):
    return F.regexp_replace(F.translate(F.lower(F.coalesce(F.col(text), F.lit(""))), *MAP), "[^ACGTN]", "")


def plain(spark, sf_dir, name) -> DataFrame:
    """A table with ß written out: only one of the engines makes two letters of it in upper case."""
    return t(spark, sf_dir, name).withColumn("text", F.replace("text", F.lit("ß"), F.lit("ss")))


def coding_documents(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "documents").select("doc_id", nucleotides().alias("nt"))


CODON_SQL = "'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'"


def residue_sql(c: str) -> str:
    place = [f"instr('TCAG', substr({c}, {k}, 1))" for k in (1, 2, 3)]
    return f"CASE WHEN length({c}) = 3 AND {' AND '.join(p + ' > 0' for p in place)} THEN substr({CODON_SQL}, ({place[0]} - 1) * 16 + ({place[1]} - 1) * 4 + {place[2]}, 1) ELSE 'X' END"


def translate_sql(s: str) -> str:
    return f"coalesce(array_to_string(list_transform(regexp_extract_all({s}, '...'), lambda c: {residue_sql('c')}), ''), '')"


LONG = "SELECT {nt} AS nt, {aa} AS aa, CAST(year({d}) AS INT) AS year, CAST(month({d}) AS INT) AS month, count(*) AS n FROM {t} GROUP BY ALL"
ORDERS_SQL = LONG.format(nt="o_orderstatus", aa="o_orderpriority", d="o_orderdate", t="orders")
LINES_SQL = LONG.format(nt="l_returnflag", aa="l_linestatus", d="l_shipdate", t="lineitem")


@query(ORDERS_SQL)
def variant_counts_long(spark, sf_dir):
    return counts.count_variants(orders(spark, sf_dir))


def wide_sql(source: str, labels: list[str], label: str) -> str:
    columns = ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE bin = '{x}'), 0) AS BIGINT) AS \"{x}\"" for x in labels)
    return f"SELECT nt, aa, {columns}, CAST(sum(n) AS BIGINT) AS \"Count\" FROM (SELECT nt, aa, n, {label} AS bin FROM ({source})) GROUP BY nt, aa"


YEARLY = "CASE WHEN year IS NULL THEN 'unknown' WHEN year < {s} THEN 'before {s}' ELSE CAST(year AS VARCHAR) END"
MONTHLY = "CASE WHEN year IS NULL OR year < {s} THEN 'unknown' WHEN month IS NULL THEN format('{{:04d}}-unknown', year) ELSE format('{{:04d}}-{{:02d}}', year, month) END"


@query(wide_sql(ORDERS_SQL, dates.calendar(1997, 2001, False), YEARLY.format(s=1997)))
def variant_counts_yearly_wide(spark, sf_dir):
    return counts.wide_counts(counts.count_variants(orders(spark, sf_dir)), start=1997, end=2001)


@query(wide_sql(LINES_SQL, dates.calendar(1996, 2001, True), MONTHLY.format(s=1996)))
def variant_counts_monthly_wide(spark, sf_dir):
    return counts.wide_counts(counts.count_variants(lines(spark, sf_dir)), monthly=True, start=1996, end=2001)


PROFILE_SQL = """SELECT source, CASE WHEN odd OR (total > 0 AND nt < 0.98 * total) THEN 'protein' ELSE 'nucleotide' END AS molecule, aligned, median_len, sampled FROM (
SELECT source, bool_or(length(core) > length(translate(core, 'EFILPQXZ*', ''))) AS odd, sum(length(core) - length(translate(core, 'ACGTUN', ''))) AS nt, sum(length(core)) AS total,
bool_or(contains(s, '-')) AND min(length(s)) = max(length(s)) AS aligned, CAST(list_sort(list(length(s)))[count(*) // 2 + 1] AS INT) AS median_len, count(*) AS sampled
FROM (SELECT source, upper(text) AS s, replace(upper(text), '-', '') AS core FROM (SELECT source, replace(text, 'ß', 'ss') AS text FROM documents)) GROUP BY source)"""


@query(PROFILE_SQL)
def file_profile(spark, sf_dir):
    return profile.engine_profile(plain(spark, sf_dir, "documents"), ["source"], "text")


SAMPLE_SQL = """SELECT source, CASE WHEN total > 0 AND nt >= 0.95 * total THEN 'nucleotide' ELSE 'protein' END AS molecule, CASE WHEN aligned THEN 'aligned' ELSE 'raw' END AS state, median_length FROM (
SELECT source, sum(length(s) - length(translate(s, 'ACGTUNRYSWKMBDHV.?-', ''))) AS nt, sum(length(s)) AS total, bool_or(contains(s, '-') OR contains(s, '.')) AND min(length(s)) = max(length(s)) AS aligned,
CAST(list_sort(list(length(s)))[count(*) // 2 + 1] AS INT) AS median_length FROM (SELECT source, upper(replace(text, 'ß', 'ss')) AS s FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10) GROUP BY source)"""


@query(SAMPLE_SQL)
def first_n_sample_profile(spark, sf_dir):
    from tidemark.sources.fasta import first_records

    return profile.scanner_profile(first_records(plain(spark, sf_dir, "documents"), 10, "source", "doc_id"), ["source"], "text")


KMER_SQL = """WITH b AS (SELECT DISTINCT item_id, k FROM (SELECT item_id, unnest(list_transform(range(1, length(s) - 8), lambda i: substr(s, i, 10))) AS k FROM (SELECT item_id, upper(replace(text, 'ß', 'ss')) AS s FROM benchmark)) WHERE NOT contains(k, 'X')),
n AS (SELECT item_id, count(*) AS kmers FROM b GROUP BY item_id),
d AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(list_transform(range(1, length(s) - 8), lambda i: substr(s, i, 10))) AS k FROM (SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS s FROM documents)) WHERE k IN (SELECT k FROM b))
SELECT doc_id, item_id, count(*) AS shared, any_value(kmers) AS kmers FROM d JOIN b USING (k) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) * 10 >= 3 * any_value(kmers)"""


@query(KMER_SQL)
def kmer_coverage(spark, sf_dir):
    d, b = (plain(spark, sf_dir, name).withColumn("seq", F.upper("text")) for name in ("documents", "benchmark"))
    return coverage.shared_kmers(d, b, "doc_id", "item_id")


@query(f"SELECT doc_id, CAST(length(aa) AS INT) AS aa_len, md5(aa) AS aa_md5 FROM (SELECT doc_id, {translate_sql('nt')} AS aa FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents))")
def translate_text(spark, sf_dir):
    aa = coding_documents(spark, sf_dir).select("doc_id", sequences.translate("nt").alias("aa"))
    return aa.select("doc_id", F.length("aa").alias("aa_len"), F.md5(F.col("aa").cast("binary")).alias("aa_md5"))


FRAME_SQL = f"""SELECT doc_id, frame, aa, nt FROM (SELECT doc_id, nt, CAST(f AS INT) AS frame, {translate_sql('substr(nt, CAST(f AS INT) + 1)')} AS aa, row_number() OVER (PARTITION BY doc_id ORDER BY stops, longest DESC, f) AS r FROM (
SELECT doc_id, nt, f, length(h) - length(replace(h, '*', '')) AS stops, list_max(list_transform(string_split(h, '*'), lambda x: length(x))) AS longest FROM (
SELECT doc_id, nt, f, {translate_sql('substr(substr(nt, 1, 1200), CAST(f AS INT) + 1)')} AS h FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents), range(3) AS r(f) WHERE least(length(nt), 1200) >= f + 3))) WHERE r = 1"""


@query(f"SELECT doc_id, frame FROM ({FRAME_SQL})")
def best_frame(spark, sf_dir):
    return coding_documents(spark, sf_dir).select("doc_id", F.explode(F.array_compact(F.array(sequences.best_frame("nt")))).alias("frame"))


@query(f"SELECT doc_id, frame, aa, md5(substr(nt, frame + 1, 3 * length(aa))) AS nt_md5 FROM (SELECT doc_id, frame, nt, string_split(aa, '*')[1] AS aa FROM ({FRAME_SQL})) WHERE length(aa) >= 20")
def cds_filter(spark, sf_dir):
    cds = coding.translate_cds(coding_documents(spark, sf_dir), 20, "nt")
    return cds.select("doc_id", "frame", "aa", F.md5(F.col("nt").cast("binary")).alias("nt_md5"))


HEADER = """CASE o_orderkey % 6 WHEN 0 THEN concat('hCoV-19/USA/', o_orderkey, '/2025|EPI_ISL_', o_custkey, '|', {d}) WHEN 1 THEN concat({d}, '|A/Singapore/ON1900/2009|EPI_ISL_', o_custkey)
WHEN 2 THEN concat('A/Swine/', o_custkey, '/', year(o_orderdate), ' (H1)') WHEN 3 THEN concat('abc ', year(o_orderdate), ' [cds_aa=1,273]') WHEN 4 THEN concat('EPI_ISL_2099', o_custkey) ELSE concat('x|', year(o_orderdate), '-13-01|', year(o_orderdate), '-00-00') END"""


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 4 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS year, CASE WHEN o_orderkey % 6 < 2 THEN CAST(month(o_orderdate) AS INT) END AS month FROM orders")
def header_date(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.expr(HEADER.format(d="date_format(o_orderdate, 'yyyy-MM-dd')")).alias("header"))
    return o.withColumn("d", dates.parse_date("header")).select("o_orderkey", "d.year", "d.month")


@query(f"SELECT label, count(*) AS n FROM (SELECT {MONTHLY.format(s=1996)} AS label FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders)) GROUP BY label")
def bin_labels(spark, sf_dir):
    return orders(spark, sf_dir).groupBy(dates.monthly_label("year", "month", 1996).alias("label")).agg(F.count("*").alias("n"))


COLUMNS = [*range(3, 13), *range(20, 30)]


@query("""SELECT doc_id, aa FROM (SELECT doc_id, concat(substr(s, 4, 10), substr(s, 21, 10)) AS aa FROM (SELECT doc_id, upper(translate(replace(text, 'ß', 'ss'), ' .', '--')) AS s FROM documents))
WHERE length(regexp_replace(aa, '[-X]', '', 'g')) >= 0.9 * 20""")
def motif_extract(spark, sf_dir):
    rows = plain(spark, sf_dir, "documents").select("doc_id", F.upper(F.translate("text", " .", "--")).alias("aln_aa"))
    return motif.extract(rows, COLUMNS).select("doc_id", "aa")


@query(f"""SELECT doc_id, aa, replace(picked, '-', '') AS nt FROM (SELECT doc_id, picked, coalesce(array_to_string(list_transform(regexp_extract_all(picked, '...'), lambda c: CASE WHEN contains(c, '-') THEN '-' ELSE {residue_sql('c')} END), ''), '') AS aa
FROM (SELECT doc_id, concat(substr(s, 1, 15), substr(s, 31, 15)) AS picked FROM (SELECT doc_id, {NT_SQL} AS s FROM documents))) WHERE length(regexp_replace(aa, '[-X*]', '', 'g')) >= 0.9 * 10""")
def codon_motif_extract(spark, sf_dir):
    rows = coding_documents(spark, sf_dir).withColumnRenamed("nt", "aln_nt")
    return motif.extract_codons(rows, [*range(5), *range(10, 15)]).select("doc_id", "aa", "nt")


@query("""SELECT CAST(pos AS INT) AS pos, value, n FROM (SELECT pos, value, n, row_number() OVER (PARTITION BY pos ORDER BY n DESC, o) AS r FROM (SELECT pos, substr(s, pos + 1, 1) AS value, count(*) AS n, min(item_id) AS o
FROM (SELECT item_id, s, unnest(range(length(s))) AS pos FROM (SELECT item_id, upper(replace(replace(text, 'ß', 'ss'), ' ', '-')) AS s FROM benchmark)) WHERE substr(s, pos + 1, 1) <> '-' GROUP BY ALL)) WHERE r = 1""")
def consensus(spark, sf_dir):
    rows = plain(spark, sf_dir, "benchmark").select("item_id", F.replace("text", F.lit(" "), F.lit("-")).alias("aln"))
    return motif.consensus_rows(rows, "aln", F.col("item_id"))


PART = "thatonthe"


@query(f"""SELECT item_id, CAST(pos AS INT) AS place, CAST(off AS INT) AS mismatches FROM (SELECT item_id, pos, off, row_number() OVER (PARTITION BY item_id ORDER BY off, pos) AS r FROM (
SELECT item_id, pos, len(list_filter(range(1, {len(PART) + 1}), lambda k: substr(text, pos + k, 1) <> substr('{PART}', k, 1))) AS off FROM (SELECT item_id, text, unnest(range(length(text) - {len(PART) - 1})) AS pos FROM benchmark))) WHERE r = 1""")
def hamming_place(spark, sf_dir):
    best = t(spark, sf_dir, "benchmark").select("item_id", F.explode(F.array_compact(F.array(motif.best_place(F.col("text"), PART)))).alias("b"))
    return best.select("item_id", "b.place", "b.mismatches")


@query("SELECT doc_id, substr(sha1(s), 1, 8) AS ref_hash, CAST(length(s) AS INT) AS len FROM (SELECT doc_id, upper(trim(translate(replace(text, 'ß', 'ss'), '-. ', ''))) AS s FROM documents)")
def upper_degap_hash(spark, sf_dir):
    s = plain(spark, sf_dir, "documents").select("doc_id", sequences.degap("text").alias("s"))
    return s.select("doc_id", sequences.reference_hash("s").alias("ref_hash"), F.length("s").alias("len"))


@query("SELECT doc_id, CASE WHEN a AND b THEN 'ok' WHEN a THEN 'new' ELSE 'missing' END AS status FROM (SELECT doc_id, bool_or(a) AS a, bool_or(NOT a) AS b FROM (SELECT doc_id, true AS a FROM documents UNION ALL SELECT doc_id, false FROM labels) GROUP BY doc_id)")
def registry_check(spark, sf_dir):
    return registry.compare(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT benchmark_file, rule, severity FROM (SELECT name AS benchmark_file, unnest([CASE WHEN size % 7 = 0 THEN 'empty host' END, CASE WHEN contains(name, ' ') AND size % 5 = 0 THEN 'letters of target_seq' END, CASE WHEN size % 3 = 0 THEN 'seq_len' END,
CASE WHEN size % 11 = 0 THEN 'recommended_reference' END]) AS rule, CASE rule WHEN 'seq_len' THEN 'warning' ELSE 'problem' END AS severity FROM (SELECT concat(p_name, p_partkey) AS name, p_size AS size FROM part)) WHERE rule IS NOT NULL""")
def registry_violations(spark, sf_dir):
    p, size = t(spark, sf_dir, "part"), F.col("p_size")
    name = F.concat("p_name", F.col("p_partkey").cast("string"))
    target = F.when((size % 5 == 0) & F.contains(name, F.lit(" ")), "MK1").otherwise("MK-V")
    rows = p.select(
        name.alias("benchmark_file"), name.alias("dms_id"), F.lit("IAV").alias("virus_code"), F.when(size % 7 == 0, "").otherwise("human").alias("host"), target.alias("target_seq"), F.lit("domain").alias("target_type"),
        F.when(size % 11 == 0, "other").otherwise("target_as_reference").alias("recommended_reference"), F.when(size % 3 == 0, "9").otherwise("3").alias("seq_len"))
    return registry.violations(rows)


@query("""SELECT substr(sha1(s), 1, 8) AS ref_hash, arg_min(lang, doc_id) AS first_lang, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS members, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS docs
FROM (SELECT doc_id, lang, upper(trim(translate(replace(text, 'ß', 'ss'), '-. ', ''))) AS s FROM documents) GROUP BY 1""")
def group_by_reference(spark, sf_dir):
    d = plain(spark, sf_dir, "documents").select("doc_id", "lang", sequences.reference_hash(sequences.degap("text")).alias("ref_hash"))
    docs = F.array_sort(F.collect_set("doc_id"))
    return d.groupBy("ref_hash").agg(F.min_by("lang", "doc_id").alias("first_lang"), F.min("doc_id").alias("first_doc"), F.count_distinct("doc_id").alias("members"), F.array_join(docs.cast("array<string>"), ",").alias("docs"))


FOLDER = "concat('IAV/', CASE WHEN p_size % 3 = 0 THEN 'human' WHEN p_size % 3 = 1 THEN 'avian' ELSE 'all' END, CASE WHEN p_size % 4 = 0 THEN '/HA' WHEN p_size % 4 = 1 THEN '/NP' ELSE '' END)"
HOSTS = "CASE WHEN s_suppkey % 3 = 0 THEN 'human' WHEN s_suppkey % 3 = 1 THEN 'avian' ELSE 'swine' END"
SEGMENTS = "CASE WHEN s_suppkey % 4 = 0 THEN 'HA' WHEN s_suppkey % 4 = 1 THEN 'PB2' WHEN s_suppkey % 4 = 2 THEN 'NP' END"


@query(f"""WITH g AS (SELECT s_suppkey, {HOSTS} AS h, {SEGMENTS} AS s FROM supplier), tiers AS (SELECT s_suppkey, unnest([CASE WHEN h <> 'swine' AND s IS NOT NULL THEN concat('IAV/', h, '/', s) END, CASE WHEN s IS NOT NULL THEN concat('IAV/all/', s) END, CASE WHEN h <> 'swine' THEN concat('IAV/', h) END, 'IAV/all', 'IAV']) AS prefix,
unnest([0, 1, 2, 3, 4]) AS tier FROM g), f AS (SELECT {FOLDER} AS folder, count(*) AS files FROM part GROUP BY 1), m AS (SELECT s_suppkey, tier, prefix, sum(files) AS files FROM tiers JOIN f ON folder = prefix OR starts_with(folder, concat(prefix, '/')) WHERE prefix IS NOT NULL GROUP BY ALL)
SELECT s_suppkey, prefix, CAST(files AS BIGINT) AS files FROM m QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY tier) = 1""")
def tier_route(spark, sf_dir):
    g = t(spark, sf_dir, "supplier").select("s_suppkey", F.expr(HOSTS).alias("h"), F.expr(SEGMENTS).alias("s"))
    g = g.select("s_suppkey", routing.folder_tiers(F.lit("IAV"), F.col("h"), F.col("s")).alias("tiers"))
    files = t(spark, sf_dir, "part").select(F.expr(FOLDER).alias("folder")).groupBy("folder").agg(F.count("*").alias("files"))
    pairs = routing.best_tier(g, files.withColumn("path", F.col("folder")), "s_suppkey").join(files.withColumnRenamed("folder", "path"), "path")
    return pairs.groupBy("s_suppkey", "prefix").agg(F.sum("files").alias("files"))


@query("""SELECT doc_id, CAST(sum(items) AS BIGINT) AS items, min(len) AS shortest, max(len) AS longest FROM (SELECT doc_id, length(text) AS n FROM documents) JOIN (SELECT CAST(length(text) AS INT) AS len, count(*) AS items FROM benchmark GROUP BY 1)
ON len > 0 AND n > 0 AND CAST(n AS DOUBLE) / len >= 0.6 AND CAST(n AS DOUBLE) / len <= 1.5 GROUP BY doc_id""")
def suitability_join(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"))
    b = t(spark, sf_dir, "benchmark").groupBy(F.length("text").alias("len")).agg(F.count("*").alias("items"))
    return routing.lengths_within(d, b, "n", "len").groupBy("doc_id").agg(F.sum("items").alias("items"), F.min("len").alias("shortest"), F.max("len").alias("longest"))


MODE_SQL = """SELECT doc_id, CASE WHEN n >= 8000 THEN 'genome' WHEN n / 3.0 / 500 BETWEEN 0.6 AND 1.5 THEN 'cds' WHEN 2000 >= 1.2 * 500 AND n / 3.0 / 2000 BETWEEN 0.6 AND 1.5 THEN 'subregion' END AS mode FROM (SELECT doc_id, CAST(length(text) AS DOUBLE) AS n FROM documents)"""


@query(MODE_SQL)
def suitability_mode(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    mode = routing.suitability(F.lit("nucleotide"), F.lit("raw"), F.length("text").cast("double"), F.lit(500), F.lit(2000))
    return d.select("doc_id", mode.alias("mode"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark, sf_dir):
    return schedule.unfinished(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id")


@query("SELECT nt, aa, year, month, CAST(sum(n) AS BIGINT) AS n FROM (" + ORDERS_SQL + " UNION ALL " + LINES_SQL + ") GROUP BY ALL")
def integrate_union(spark, sf_dir):
    return counts.integrate([counts.count_variants(f(spark, sf_dir)) for f in (orders, lines)])


@query(f"SELECT nt, aa, bin, CAST(sum(n) AS BIGINT) AS n FROM (SELECT nt, aa, n, CASE WHEN year >= 1999 AND year <= 2000 THEN CAST(year AS VARCHAR) ELSE 'unknown' END AS bin FROM ({LINES_SQL})) GROUP BY ALL")
def melt_relabel(spark, sf_dir):
    wide = counts.wide_counts(counts.count_variants(lines(spark, sf_dir)), start=1996, end=2001)
    return counts.merge_bins(counts.from_wide(wide, counts.KEYS), counts.KEYS, False, 1999, 2000)


@query("SELECT doc_id FROM (SELECT doc_id, upper(replace(replace(text, 'ß', 'ss'), ' ', '-')) AS s FROM documents) WHERE CASE WHEN length(s) = 0 THEN 1.0 ELSE CAST(length(regexp_replace(s, '[^-X]', '', 'g')) AS DOUBLE) / length(s) END <= 0.1")
def gap_filter(spark, sf_dir):
    d = plain(spark, sf_dir, "documents").select("doc_id", F.upper(F.replace("text", F.lit(" "), F.lit("-"))).alias("aa"))
    return counts.called(d).select("doc_id")


@query("SELECT coalesce(c_mktsegment, 'TOTAL') AS segment, count(*) AS customers, CAST(sum(c_nationkey) AS BIGINT) AS keys FROM customer GROUP BY ROLLUP (c_mktsegment)")
def summary_total(spark, sf_dir):
    by = t(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("customers"), F.sum("c_nationkey").alias("keys"))
    return counts.with_total(by, "segment")


@query("SELECT nt, aa, count(*) AS n FROM (SELECT o_orderstatus AS nt, o_orderpriority AS aa FROM orders) GROUP BY ALL ORDER BY n DESC, nt, aa LIMIT 7")
def topk_variants(spark, sf_dir):
    return counts.top_variants(counts.count_variants(orders(spark, sf_dir)), 7).select("nt", "aa", F.col("n").cast("long").alias("n"))


@query("""SELECT c_name AS group_id, CAST(CASE WHEN many THEN r - 1 ELSE before + (r - 1) // 10 END AS BIGINT) AS wave FROM (SELECT c_name, c_nationkey < 3 AS many, row_number() OVER (PARTITION BY c_nationkey < 3 ORDER BY c_name) AS r, sum(CASE WHEN c_nationkey < 3 THEN 1 ELSE 0 END) OVER () AS before FROM customer)""")
def wave_batches(spark, sf_dir):
    g = t(spark, sf_dir, "customer").select(F.col("c_name").alias("group_id"), F.when(F.col("c_nationkey") < 3, 2).otherwise(1).alias("files"))
    return schedule.waves(g, 10)


@query("SELECT doc_id, coalesce(regexp_matches(text, '(?s)thing.*?ed.*?tion'), false) AS found FROM documents")
def parts_in_order(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.coalesce(sequences.parts_in_order(["thing", "ed", "tion"], "text"), F.lit(False)).alias("found"))


NAMED = "CASE WHEN p_size % 5 = 0 THEN concat(p_name, ' RNA polymerase PB1') WHEN p_size % 5 = 1 THEN concat(p_name, ' hemagglutinin') WHEN p_size % 5 = 2 THEN 'alpha subunit' WHEN p_size % 5 = 3 THEN concat('NA ', p_name) ELSE p_name END"
FILED = "CASE WHEN p_size % 4 = 0 THEN concat(p_name, '_PA.fasta') WHEN p_size % 4 = 1 THEN 'x/gisaid_H3N2.fa' WHEN p_size % 4 = 2 THEN 'NP-1.fasta' ELSE 'all.fasta' END"


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'PB1' WHEN 1 THEN 'HA' WHEN 3 THEN 'NA' END AS by_protein, CASE p_size % 4 WHEN 0 THEN 'PA' WHEN 1 THEN 'HA' WHEN 2 THEN 'NP' END AS by_file FROM part""")
def segment_hints(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", F.expr(NAMED).alias("protein"), F.expr(FILED).alias("path"))
    return p.select("p_partkey", texts.segment_of_protein("protein").alias("by_protein"), texts.segment_of_file("path").alias("by_file"))


AUDIT_BINS = f"SELECT source, nt, aa, bin, count(*) AS n FROM (SELECT source, substr(sha1(coalesce(text, '')), 1, 2) AS nt, upper(replace(replace(coalesce(text, ''), 'ß', 'ss'), ' ', '-')) AS aa, CASE WHEN n_chars % 4 = 0 THEN 'unknown' ELSE CAST(2000 + n_chars % 4 AS VARCHAR) END AS bin FROM documents) WHERE aa <> '' GROUP BY ALL"


@query(f"""SELECT source, count(DISTINCT (nt, aa)) FILTER (WHERE ok) AS variants_kept, count(DISTINCT (nt, aa)) FILTER (WHERE NOT ok) AS variants_dropped, CAST(coalesce(sum(n) FILTER (WHERE ok), 0) AS BIGINT) AS counts_kept, CAST(coalesce(sum(n) FILTER (WHERE NOT ok), 0) AS BIGINT) AS counts_dropped,
min(bin) FILTER (WHERE ok AND bin <> 'unknown') AS first_bin, max(bin) FILTER (WHERE ok AND bin <> 'unknown') AS last_bin, CAST(coalesce(sum(n) FILTER (WHERE ok AND bin = 'unknown'), 0) AS BIGINT) AS unknown_kept, CAST(coalesce(sum(n) FILTER (WHERE bin = 'unknown'), 0) AS BIGINT) AS unknown_all
FROM (SELECT *, CAST(length(regexp_replace(aa, '[^-X]', '', 'g')) AS DOUBLE) / length(aa) <= 0.1 AS ok FROM ({AUDIT_BINS})) GROUP BY source""")
def aggregation_audit(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("text"), "n_chars")
    bin_ = F.when(F.col("n_chars") % 4 == 0, "unknown").otherwise((2000 + F.col("n_chars") % 4).cast("string"))
    rows = d.select("source", F.substring(F.sha1(F.col("text").cast("binary")), 1, 2).alias("nt"), F.upper(F.replace(F.replace("text", F.lit("ß"), F.lit("ss")), F.lit(" "), F.lit("-"))).alias("aa"), bin_.alias("bin"), F.lit(1).alias("n"))
    return counts.audit(counts.merge_bins(rows, ["source", "nt", "aa"], False, 1950, 2100), ["source"])


@query("SELECT benchmark, nt, aa, n FROM (SELECT o_orderstatus AS nt, o_orderpriority AS aa, count(*) AS n FROM orders GROUP BY ALL) JOIN (SELECT l_returnflag AS f, CASE WHEN l_returnflag = 'A' THEN 'F' WHEN l_returnflag = 'N' THEN 'O' ELSE 'P' END AS nt, concat(l_returnflag, l_linestatus) AS benchmark FROM lineitem GROUP BY ALL) USING (nt)")
def training_fan_out(spark, sf_dir):
    rows = counts.count_variants(orders(spark, sf_dir)).groupBy("nt", "aa").agg(F.sum("n").alias("n"))
    x = t(spark, sf_dir, "lineitem").select(F.when(F.col("l_returnflag") == "A", "F").when(F.col("l_returnflag") == "N", "O").otherwise("P").alias("nt"), F.concat("l_returnflag", "l_linestatus").alias("b"))
    return counts.fan_out(rows, x.groupBy("nt").agg(F.collect_set("b").alias("benchmarks")), ["nt"]).select("benchmark", "nt", "aa", "n")


@query("SELECT count(*) AS files, CAST(sum(l_quantity) AS BIGINT) AS records, CAST(sum(l_linenumber) AS BIGINT) AS bytes FROM lineitem")
def inventory_totals(spark, sf_dir):
    x = t(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("long").alias("n_records"), F.col("l_linenumber").cast("long").alias("size_bytes"))
    return profile.totals(x)


@query(ORDERS_SQL)
def incremental_counts(spark, sf_dir):
    """The long counts of orders, added batch by batch by a stream that ends when all files are read."""
    import uuid

    from tidemark.session import shared_folder

    top = f"{shared_folder(spark)}/tidemark-stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/orders.parque[t]")

    def to_fragments(batch):
        return batch.select(F.col("o_orderstatus").alias("nt"), F.col("o_orderpriority").alias("aa"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))

    incremental.count_stream(stream, to_fragments, f"{top}/counts", f"{top}/state").awaitTermination()
    return incremental.read_stream_counts(spark, f"{top}/counts")


from tidemark import queries_files  # noqa: E402, F401 - registers more queries
