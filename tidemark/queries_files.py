"""Registered queries of the engine's files, plans and runs: each writes what it needs to the shared folder, reads it back and has a SQL twin over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences, texts
from tidemark.operators import align, coding, counts, motif, profile
from tidemark.plans import catalogue, grouping, integration, inventory, pipeline, runs, schedule, taskplan, training
from tidemark.queries import LINES_SQL, NT_SQL, ORDERS_SQL, YEARLY, coding_documents, lines, orders, plain, query, t, translate_sql
from tidemark.session import shared_folder
from tidemark.sources import config, fasta, files, tables
from tidemark.streaming import incremental


def folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}/{name}"


#: Bytes of a file above which it is written in parts, and those of a part, about.
PART = 64 << 20


def as_files(records: DataFrame, root: str, most: int = PART) -> str:
    """Writes records (path, place, description, seq) as FASTA files below root, a file's records by place. A file of more than `most` bytes is a folder of parts, each made by a task of its own.

    Parts are ranges of like numbers of records, so only large files whose records are of like length (within twice) are dealt together: a file of few long records has as many parts as its bytes ask for."""
    spark = records.sparkSession
    text = F.concat(F.lit(">"), "description", F.lit("\n"), "seq")
    rows = runs.stored(records.select(F.hex(F.encode("path", "UTF-8")).alias("name"), "place", text.alias("value")), f"{root}-rows")  # made once, read for the sizes, the ranges and the files
    sizes, alike = {}, {}
    for r in rows.groupBy("name").agg(F.sum(F.octet_length("value")).alias("bytes"), F.count("*").alias("n")).toLocalIterator():
        sizes[r.name] = r.bytes or 0
        if sizes[r.name] > most:
            alike.setdefault((sizes[r.name] // r.n).bit_length(), []).append(r.name)
    large = [name for found in alike.values() for name in found]
    dealt = [(rows.where(~F.col("name").isin(large)).repartition(max(1, len(sizes) - len(large)), "name"), "small")] if len(large) < len(sizes) or not sizes else []
    dealt += [(rows.where(F.col("name").isin(found)).repartitionByRange(sum(-(-sizes[name] // most) for name in found), "name", "place"), f"large{k}") for k, found in alike.items()]
    for own, kind in dealt:  # sorted by what the writer asks for, too: a second sort by name alone would take the first one's place
        own.sortWithinPartitions("name", "place").select("name", "value").write.partitionBy("name").text(f"{root}-{kind}")
        made = {}
        for f, _ in files.walk(spark, f"{root}-{kind}"):
            if "/part-" in f:
                made.setdefault(bytes.fromhex(f.split("/")[0].removeprefix("name=")).decode(), []).append(f)
        for path, found in made.items():
            for k, f in enumerate(found):  # by name, in the order of the tasks
                fs, src = files._at(spark, f"{root}-{kind}/{f}")
                dst = files._at(spark, f"{root}/{path}" + (f"/part-{k:05d}.fasta" if len(found) > 1 else ""))[1]
                fs.mkdirs(dst.getParent())
                fs.rename(src, dst)
    return root


KIND = "CASE WHEN doc_id % 20 < 14 THEN 'raw' WHEN doc_id % 20 < 17 THEN 'aligned' ELSE 'protein' END"
PATH = "concat('d', doc_id % 3, '/', CASE WHEN doc_id % 2 = 0 THEN 'x/' ELSE '' END, 's', doc_id % 20, CASE doc_id % 20 % 4 WHEN 0 THEN '.fasta' WHEN 1 THEN '.Fa' WHEN 2 THEN '.FNA' ELSE '.faa' END)"
SEQ = f"CASE {KIND} WHEN 'raw' THEN nt WHEN 'aligned' THEN rpad(substr(nt, 1, 40), 42, '-') ELSE concat('MEFPIL', substr(nt, 1, 5)) END"
SEQ_SQL = f"(SELECT doc_id, {PATH} AS path, concat('r', doc_id, '|x|', 1990 + doc_id % 40) AS description, {SEQ} AS seq FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents))"


def fasta_folder(spark, sf_dir) -> str:
    d = coding_documents(spark, sf_dir)
    rows = d.select(F.expr(PATH).alias("path"), F.col("doc_id").alias("place"), F.concat(F.lit("r"), "doc_id", F.lit("|x|"), (1990 + F.col("doc_id") % 40).cast("string")).alias("description"), F.expr(SEQ).alias("seq"))
    return as_files(rows, folder(spark, "fasta"))


@query(f"SELECT doc_id, concat('s', doc_id % 20) AS dataset, description, md5(seq) AS seq_md5, length(seq) AS len, CAST(1990 + doc_id % 40 AS INT) AS year FROM {SEQ_SQL}")
def fasta_read(spark, sf_dir):
    """Records of a tree of files, written and read."""
    r = fasta.read_fasta(spark, fasta_folder(spark, sf_dir), recursive=True)
    return r.select(
        F.regexp_extract("rec_id", r"^r(\d+)", 1).cast("long").alias("doc_id"), "dataset", "description", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.length("seq").cast("long").alias("len"), dates.parse_date("description").year.alias("year"))


@query(f"SELECT path AS rel_path, count(*) AS n_records FROM {SEQ_SQL} GROUP BY path")
def fasta_counts(spark, sf_dir):
    root = fasta_folder(spark, sf_dir)
    n = fasta.count_records(fasta.read_fasta(spark, root, recursive=True))
    top = len(files.qualified(spark, root)) + 2
    return n.select(F.substring(F.col("file_path"), F.lit(top), F.length("file_path")).alias("rel_path"), "n_records")


@query(f"""SELECT path AS rel_path, regexp_replace(path, '/[^/]*$', '') AS folder, CASE WHEN sum(nt) FILTER (WHERE r <= 5) >= 0.95 * sum(len) FILTER (WHERE r <= 5) THEN 'nucleotide' ELSE 'protein' END AS molecule,
CASE WHEN bool_or(gap) FILTER (WHERE r <= 5) AND min(len) FILTER (WHERE r <= 5) = max(len) FILTER (WHERE r <= 5) THEN 'aligned' ELSE 'raw' END AS state,
list_sort(list(len) FILTER (WHERE r <= 5))[count(*) FILTER (WHERE r <= 5) // 2 + 1] AS median_length, count(*) AS n_records, CAST(sum(size) AS BIGINT) AS size_bytes
FROM (SELECT path, length(seq) AS len, length(regexp_replace(seq, '[^ACGTUNRYSWKMBDHV.?-]', '', 'g')) AS nt, contains(seq, '-') AS gap, length(description) + length(seq) + 3 AS size, row_number() OVER (PARTITION BY path ORDER BY doc_id) AS r FROM {SEQ_SQL}) GROUP BY path""")
def inventory_scan(spark, sf_dir):
    """The scan of a tree of files, by the first five records of each; through the inventory document."""
    root = fasta_folder(spark, sf_dir)
    files.write_json(inventory.document(inventory.scan(spark, root, 5), root, 5), f"{root}-inventory.json")
    return tables.read_inventory(spark, f"{root}-inventory.json").drop("path")


@query("SELECT DISTINCT concat('s', doc_id % 20) AS dataset FROM documents WHERE doc_id % 20 = 1")
def dataset_filter(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.concat(F.lit("s"), (F.col("doc_id") % 20).cast("string"), F.lit(".fasta")).alias("path"), F.col("doc_id").alias("place"), F.lit("x").alias("description"), F.lit("A").alias("seq"))
    return fasta.datasets(spark, as_files(d, folder(spark, "flat")), "s1.fasta").select("dataset")


@query("SELECT 1 AS k, (SELECT md5(seq) FROM (SELECT arg_min(nt, doc_id) AS seq FROM (SELECT doc_id, " + NT_SQL + " AS nt FROM documents))) AS seq_md5")
def single_record(spark, sf_dir):
    d = coding_documents(spark, sf_dir).select(F.lit("one.fa").alias("path"), F.col("doc_id").alias("place"), F.lit("x").alias("description"), F.col("nt").alias("seq"))
    seq = fasta.single_sequence(spark, as_files(d, folder(spark, "one")) + "/one.fa")
    return spark.range(1).select(F.lit(1).alias("k"), F.md5(F.lit(seq).cast("binary")).alias("seq_md5"))


REFERENCE = "MKTAYIAKQRQISFVKSHFSRQDILDLWQYHNGE"
CODONS = "ATGAAAACTGCTTATATTGCTAAACAACGTCAAATTTCTTTTGTTAAATCTCATTTTTCTCGTCAAGATATTCTTGATCTTTGGCAATATCATAATGGTGAA"
#: Records by kind, and their codons in the reference's columns: the reference itself, inside other residues, with a substitution (alone and inside others), without four residues, with four
#: more, without one and with another 12 residues later, twice (once changed), its middle alone, and a repeated residue in place of its beginning.
GENE = """CASE p_partkey % 10 WHEN 0 THEN g WHEN 1 THEN concat(repeat('GGT', 1 + CAST(p_size % 4 AS INT)), g, 'CCTCCT') WHEN 2 THEN concat(substr(g, 1, 27), 'TGG', substr(g, 31)) WHEN 3 THEN concat('GGTGGT', substr(g, 1, 27), 'TGG', substr(g, 31), 'CCT')
WHEN 4 THEN concat(substr(g, 1, 45), substr(g, 58)) WHEN 5 THEN concat(substr(g, 1, 51), 'GGTGGTGGTGGT', substr(g, 52)) WHEN 6 THEN concat(substr(g, 1, 27), substr(g, 31, 36), 'TGG', substr(g, 67)) WHEN 7 THEN concat(substr(g, 1, 27), 'TGG', substr(g, 31), 'GGT', g)
WHEN 8 THEN substr(g, 31, 60) ELSE concat(repeat('CAA', 9 + CAST(p_size % 7 AS INT)), substr(g, 10)) END"""
ALIGNED = """CASE p_partkey % 10 WHEN 2 THEN concat(substr(g, 1, 27), 'TGG', substr(g, 31)) WHEN 3 THEN concat(substr(g, 1, 27), 'TGG', substr(g, 31)) WHEN 4 THEN concat(substr(g, 1, 45), repeat('-', 12), substr(g, 58))
WHEN 6 THEN concat(substr(g, 1, 27), '---', substr(g, 31)) WHEN 8 THEN concat(repeat('-', 30), substr(g, 31, 60), repeat('-', 12)) WHEN 9 THEN concat('CAACAACAA', substr(g, 10)) ELSE g END"""


@query(f"""SELECT p_partkey, {translate_sql('nt')} AS aa, aln_nt, coalesce(array_to_string(list_transform(regexp_extract_all(aln_nt, '...'), lambda c: CASE WHEN c = '---' THEN '-' ELSE {translate_sql('c')} END), ''), '') AS aln_aa
FROM (SELECT p_partkey, {GENE} AS nt, {ALIGNED} AS aln_nt FROM (SELECT p_partkey, p_size, '{CODONS}' AS g FROM part))""")
def anchored_alignment(spark, sf_dir):
    """Peptides and codons anchored to a reference: substitutions, flanks, gaps, shifts, repeats and fragments, each with one best alignment."""
    p = t(spark, sf_dir, "part").withColumn("g", F.lit(CODONS)).select("p_partkey", F.expr(GENE).alias("nt"))
    rows = p.withColumn("aa", sequences.translate("nt"))
    return align.align_to_reference(rows, REFERENCE, apart=("p_partkey",)).select("p_partkey", "aa", "aln_aa", "aln_nt")


ORF_SQL = f"""WITH f AS (SELECT doc_id, nt, CAST(f AS INT) AS frame, string_split({translate_sql('substr(nt, CAST(f AS INT) + 1)')}, '*') AS p FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents), range(3) AS r(f)),
s AS (SELECT doc_id, nt, frame, i, p[i] AS aa, frame + 3 * CAST(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x) + 1)), 0) AS INT) AS begin_at FROM (SELECT doc_id, nt, frame, p, unnest(range(1, len(p) + 1)) AS i FROM f)),
r AS (SELECT arg_max(aa, (length(aa), -frame, -i)) AS aa FROM s WHERE doc_id = (SELECT min(doc_id) FROM documents)),
k AS (SELECT DISTINCT substr(aa, CAST(j AS INT), 10) AS k FROM r, range(1, 100000) AS x(j) WHERE j <= length(aa) - 9 AND NOT contains(substr(aa, CAST(j AS INT), 10), 'X')),
h AS (SELECT doc_id, frame, i, any_value(nt) AS nt, any_value(aa) AS aa, any_value(begin_at) AS begin_at, count(DISTINCT substr(aa, CAST(j AS INT), 10)) AS n FROM (SELECT *, unnest(range(1, length(aa) - 8)) AS j FROM s WHERE length(aa) >= 10) WHERE substr(aa, CAST(j AS INT), 10) IN (SELECT k FROM k) GROUP BY doc_id, frame, i)
SELECT doc_id, frame, aa, substr(nt, begin_at + 1, 3 * length(aa)) AS nt, CAST(n AS DOUBLE) / (SELECT count(*) FROM k) AS score FROM h WHERE CAST(n AS DOUBLE) / (SELECT count(*) FROM k) >= 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, frame, i) = 1"""


@query(ORF_SQL)
def orf_extract(spark, sf_dir):
    """Stop-free segments of documents (as nucleotides) that match the first document's longest one."""
    d = coding_documents(spark, sf_dir)
    first = d.agg(F.min_by("nt", "doc_id").alias("nt"))
    def sized(f):
        return F.transform(coding.stop_free(F.col("nt"), f), lambda aa, i: F.struct(F.length(aa).alias("n"), F.lit(-f).alias("f"), (-i).alias("i"), aa.alias("aa")))

    pieces = F.concat(*(sized(f) for f in range(3)))
    reference = first.select(F.array_max(pieces).aa).first()[0] or ""
    return coding.extract_orfs(d.withColumnRenamed("nt", "seq"), reference, 10).select("doc_id", "frame", "aa", "nt", "score")


@query(f"""SELECT doc_id, p[i] AS seq, CAST(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x) + 1)), 0) AS INT) AS start FROM (SELECT doc_id, p, list_position(list_transform(p, lambda x: length(x)), list_max(list_transform(p, lambda x: length(x)))) AS i
FROM (SELECT doc_id, string_split({translate_sql('nt')}, '*') AS p FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents))) WHERE length(p[i]) > 0""")
def longest_orf(spark, sf_dir):
    d = coding_documents(spark, sf_dir).select("doc_id", F.explode(F.array_compact(F.array(sequences.longest_orf(sequences.translate("nt"))))).alias("o"))
    return d.select("doc_id", "o.seq", "o.start")


@query("""WITH b AS (SELECT item_id, s, list_distinct(list_filter(list_transform(range(1, length(s) - 8), lambda i: substr(s, i, 10)), lambda k: NOT contains(k, 'X'))) AS k FROM (SELECT item_id, upper(replace(text, 'ß', 'ss')) AS s FROM benchmark))
SELECT a.item_id, CAST(len(list_intersect(a.k, r.k)) AS DOUBLE) / len(r.k) AS score FROM b a, (SELECT k FROM b ORDER BY item_id LIMIT 1) r""")
def coverage_score(spark, sf_dir):
    b = plain(spark, sf_dir, "benchmark").select("item_id", F.upper("text").alias("s"))
    first = b.agg(F.min_by("s", "item_id")).first()[0]
    return b.select("item_id", sequences.kmer_coverage("s", F.lit(first)).alias("score"))


@query("""SELECT p_partkey, regexp_replace(concat(p_name, '.x y', p_size), '[^A-Za-z0-9_\\-]', '_', 'g') AS tag, concat(p_name, '.part') AS stem, concat('b', p_size) AS benchmark, substr(concat('tm_', repeat(p_name, 30), '_', p_size), 1, 200) AS job,
CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS number, concat('[orf_aa=', CASE WHEN p_partkey >= 1000 THEN concat(p_partkey // 1000, ',', lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')) ELSE CAST(p_partkey AS VARCHAR) END, '] [frame +', p_size % 3 + 1, '] [kmer_score=0.50]') AS note FROM part""")
def text_names(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    number = F.when(F.col("p_size") % 3 == 0, "n/a").when(F.col("p_size") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".7"))).otherwise(F.col("p_size").cast("string"))
    return p.select(
        "p_partkey", texts.safe_tag(F.concat("p_name", F.lit(".x y"), F.col("p_size").cast("string"))).alias("tag"), texts.file_stem(F.concat(F.lit("/a.b/"), "p_name", F.lit(".part.fa"))).alias("stem"),
        texts.benchmark_stem(F.concat(F.lit("b"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, ".csv").otherwise(".CSV"))).alias("benchmark"),
        texts.job_name(F.repeat("p_name", F.lit(30)), F.col("p_size").cast("string")).alias("job"), texts.whole_number(number).alias("number"),
        texts.annotation("orf", F.col("p_partkey"), F.col("p_size") % 3, F.lit(0.5)).alias("note"))


@query(f"""SELECT CAST(pos AS INT) AS pos, value, n FROM (SELECT pos, value, n, row_number() OVER (PARTITION BY pos ORDER BY n DESC, o) AS r FROM (SELECT pos, substr(s, 3 * pos + 1, 3) AS value, count(*) AS n, min(doc_id) AS o
FROM (SELECT doc_id, s, unnest(range(length(s) // 3)) AS pos FROM (SELECT doc_id, substr({NT_SQL}, 1, 90) AS s FROM documents)) WHERE regexp_full_match(substr(s, 3 * pos + 1, 3), '[ACGT]{{3}}') GROUP BY ALL)) WHERE r = 1""")
def codon_consensus(spark, sf_dir):
    rows = coding_documents(spark, sf_dir).select("doc_id", F.substring("nt", 1, 90).alias("aln"))
    return motif.codon_consensus_rows(rows, "aln", F.col("doc_id"))


PARTS = ["THE", "AND"]


@query("""WITH d AS (SELECT doc_id, upper(replace(replace(text, 'ß', 'ss'), ' ', '-')) AS s FROM documents), g AS (SELECT doc_id, s, replace(s, '-', '') AS u FROM d),
f AS (SELECT s, u, strpos(u, 'THE') AS a FROM g WHERE strpos(u, 'THE') > 0 AND strpos(substr(u, strpos(u, 'THE') + 3), 'AND') > 0 ORDER BY doc_id LIMIT 1), x AS (SELECT list_filter(range(0, length(s)), lambda i: substr(s, CAST(i AS INT) + 1, 1) <> '-') AS cols, a, a + 2 + strpos(substr(u, a + 3), 'AND') AS b FROM f)
SELECT CAST(place AS BIGINT) AS place, CAST(col AS BIGINT) AS col FROM (SELECT unnest(range(6)) AS place, unnest(list_concat(cols[a:a + 2], cols[b:b + 2])) AS col FROM x)""")
def motif_columns(spark, sf_dir):
    """Alignment columns of two parts by the first row that has them, checked against that row as a reference."""
    rows = plain(spark, sf_dir, "documents").select(F.lit("f").alias("file_path"), F.col("doc_id").alias("ordinal"), F.upper(F.replace("text", F.lit(" "), F.lit("-"))).alias("aln_aa"))
    found = motif.columns_in_data(rows, PARTS)
    row = rows.where(sequences.parts_in_order(PARTS, F.replace("aln_aa", F.lit("-"), F.lit("")))).agg(F.min_by("aln_aa", "ordinal")).first()[0]
    assert motif.columns_in_reference(row, PARTS) == found
    return spark.createDataFrame(list(enumerate(found)), "place long, col long")


@query(f"""SELECT dropped, count(*) AS n FROM (SELECT CASE WHEN length(regexp_replace(aa, '[-X]', '', 'g')) < 0.9 * 12 THEN 'ambiguous' WHEN length(nt) < 36 OR length(replace(substr(nt, 1, 36), '-', '')) < 3 * length(regexp_replace(aa, '[-X]', '', 'g')) THEN 'nt' ELSE 'kept' END AS dropped
FROM (SELECT concat(substr({translate_sql('substr(nt, 1, 33)')}, 1, 11), 'K') AS aa, nt FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents)) WHERE length(aa) = 12) GROUP BY dropped""")
def motif_judged(spark, sf_dir):
    """Why fragments are dropped."""
    d = coding_documents(spark, sf_dir).withColumn("aln_aa", F.concat(sequences.translate(F.substring("nt", 1, 33)), F.lit("K"))).where(F.length("aln_aa") == 12)
    out = motif.judged(d.withColumnRenamed("nt", "aln_nt"), list(range(12)), aln_nt="aln_nt")
    return out.groupBy(F.coalesce("dropped", F.lit("kept")).alias("dropped")).agg(F.count("*").alias("n"))


@query("SELECT source, CAST(m AS BIGINT) AS median_len, CAST(m AS DOUBLE) / 3 > 1.5 * 400 AS genome FROM (SELECT source, list_sort(list(length(text)))[count(text) // 2 + 1] AS m FROM documents GROUP BY source)")
def genome_rule(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("source", F.length("text").alias("len")).groupBy("source").agg(profile.upper_median("len").alias("median_len"))
    return d.withColumn("genome", profile.is_genome(F.col("median_len"), 400))


@query("SELECT label, CAST(row_number() OVER (ORDER BY k, label) - 1 AS BIGINT) AS place FROM (SELECT concat('before ', min(year(o_orderdate))) AS label, 0 AS k FROM orders UNION ALL SELECT DISTINCT CAST(y AS VARCHAR), 1 FROM (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders) UNION ALL SELECT 'unknown', 2)")
def year_axis(spark, sf_dir):
    """The labels of the observed years, in the order of columns."""
    start, end = counts.year_range(counts.count_variants(orders(spark, sf_dir)))
    labels = sorted(dates.calendar(start, end, False), key=dates.label_order)
    return spark.createDataFrame([(x, k) for k, x in enumerate(labels)], "label string, place long")


@query("SELECT o_orderkey, CASE WHEN 2015 + o_orderkey % 40 BETWEEN 2019 AND year(current_date) + 1 THEN true ELSE false END AS ok FROM orders")
def plausible_years(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", dates.label_valid((2015 + F.col("o_orderkey") % 40).cast("string"), False, dates.MIN_YEAR["SCV2"]).alias("ok"))


CONFIGS = {
    "both": ">protein_reference\nMK TA\n>motif_reference_a b\nMK+TA\n>motif_reference_c\nTA\n".replace("a b", "a.b"), "plain": ">motif_reference\nmk\n", "bad letter": ">protein\nMK1\n", "two": ">protein\nMK\n>protein x\nMK\n",
    "odd": ">other\nMK\n", "twice": ">motif_reference_a\nM\n>motif_reference_a\nK\n", "none": "\n",
}


@query("SELECT * FROM (VALUES ('both', 'MKTA', 'a_b:MK+TA;c:TA'), ('plain', '', 'motif:MK'), ('bad letter', 'error', ''), ('two', 'error', ''), ('odd', 'error', ''), ('twice', 'error', ''), ('none', 'error', '')) AS v(name, protein, motifs)")
def config_files(spark, sf_dir):
    """Configurations as files, found by name or as the folder's shared one, parsed with all checks."""
    top, rows = folder(spark, "config"), []
    for k, (name, text) in enumerate(CONFIGS.items()):
        files.write_text(spark, f"{top}/{k}/{'reference' if k % 2 else name}.txt", text)
        found = config.find(f"{top}/{k}", name, lambda p: files.exists(spark, p))
        try:
            c = config.parse(files.read_text(spark, found))
            assert config.parse(config.render(c)) == c
            rows.append((name, c.protein or "", ";".join(f"{m.tag}:{'+'.join(m.parts)}" for m in c.motifs)))
        except ValueError:
            rows.append((name, "error", ""))
    return spark.createDataFrame(rows, "name string, protein string, motifs string")


#: A registry made of nations: rows with equal references, rows without a target, with a whole protein, with a null.
NATIONS = """SELECT concat(replace(n_name, ' ', '_'), '.csv') AS benchmark_file, n_name AS dms_id, CASE n_regionkey WHEN 0 THEN 'SCV2' WHEN 1 THEN 'HIV' ELSE 'IAV' END AS virus_code, CASE WHEN n_nationkey % 2 = 0 THEN 'human' ELSE 'avian' END AS host,
CASE WHEN n_nationkey % 11 = 5 THEN '' ELSE repeat('MK-T', 20 + CAST(n_nationkey % 4 AS INT)) END AS target_seq, 'x' AS target_type, CASE WHEN n_nationkey % 6 = 0 THEN 'full_protein_plus_motif' ELSE 'target_as_reference' END AS recommended_reference,
CASE WHEN n_nationkey % 12 = 0 THEN repeat('MKTAW', 50) ELSE '' END AS full_protein_seq, CASE WHEN n_nationkey % 3 = 0 THEN 'hemagglutinin' ELSE '' END AS protein, CASE WHEN n_nationkey % 5 = 0 THEN '300' ELSE '' END AS uniprot_full_len, n_nationkey AS ordinal FROM nation"""
#: Of its rows those that can be planned, with group key and the attributes of the group's first row.
GROUPED = f"""SELECT *, substr(sha1(reference), 1, 8) AS h FROM (SELECT *, replace(target_seq, '-', '') AS target, CASE WHEN recommended_reference = 'full_protein_plus_motif' THEN nullif(full_protein_seq, '') ELSE replace(target_seq, '-', '') END AS reference FROM ({NATIONS})) WHERE target <> '' AND reference IS NOT NULL"""
GROUP_SQL = f"""SELECT concat(arg_min(virus_code, ordinal), '_', any_value(length(reference)), 'aa_', h) AS group_id, h, arg_min(virus_code, ordinal) AS virus_code, arg_min(host, ordinal) AS host, any_value(length(reference)) AS ref_len, arg_min(protein, ordinal) AS protein, arg_min(uniprot_full_len, ordinal) AS parent,
array_to_string(list_sort(list(DISTINCT benchmark_file)), ';') AS benchmarks, count(DISTINCT target) AS motifs FROM ({GROUPED}) GROUP BY h"""


def nations(spark, sf_dir) -> DataFrame:
    """The registry, through a CSV file."""
    path = folder(spark, "registry.csv")
    t(spark, sf_dir, "nation").createOrReplaceTempView("nation")
    files.write_csv(spark.sql(NATIONS).orderBy("ordinal").drop("ordinal"), path)
    return tables.read_registry(spark, path)


@query(f"SELECT group_id, CAST(ref_len AS INT) AS ref_len, CASE WHEN virus_code = 'SCV2' THEN 'monthly' ELSE 'yearly' END AS binning, CASE WHEN protein = 'hemagglutinin' THEN 'HA' END AS segment, benchmarks, CAST(motifs AS INT) AS motifs FROM ({GROUP_SQL})")
def group_registry(spark, sf_dir):
    g = grouping.groups(grouping.usable(nations(spark, sf_dir)))
    return g.select("group_id", "ref_len", "binning", "segment", F.array_join("benchmarks", ";").alias("benchmarks"), F.size("motifs").alias("motifs"))


STOCK = """SELECT concat('/x/', folder, '/f', s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '_PB2' ELSE '' END, '.fasta') AS path, concat(folder, '/f', s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '_PB2' ELSE '' END, '.fasta') AS rel_path, folder, CASE WHEN s_suppkey % 3 = 0 THEN 'protein' ELSE 'nucleotide' END AS molecule,
CASE WHEN s_suppkey % 7 = 0 THEN 'aligned' ELSE 'raw' END AS state, CAST(s_suppkey * 9 AS BIGINT) AS median_length, CAST(s_suppkey AS BIGINT) AS n_records, CAST(1 AS BIGINT) AS size_bytes
FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'IAV/human' WHEN 1 THEN 'IAV' WHEN 2 THEN 'SCV2' ELSE 'IAV/all/HA' END AS folder FROM supplier)"""


def decided(spark, sf_dir):
    t(spark, sf_dir, "supplier").createOrReplaceTempView("supplier")
    return taskplan.decide(nations(spark, sf_dir), spark.sql(STOCK))


RATIO = "{a} >= 0.6 AND {a} <= 1.5"
PLAN_SQL = f"""WITH g AS (SELECT *, CASE WHEN protein = 'hemagglutinin' THEN 'HA' END AS seg FROM ({GROUP_SQL})), f AS ({STOCK}),
tiers AS (SELECT group_id, unnest(CASE WHEN virus_code = 'IAV' THEN [CASE WHEN seg IS NOT NULL THEN concat('IAV/', host, '/', seg) END, CASE WHEN seg IS NOT NULL THEN concat('IAV/all/', seg) END, concat('IAV/', host), 'IAV/all', 'IAV'] ELSE [virus_code] END) AS tier, unnest(CASE WHEN virus_code = 'IAV' THEN [0, 1, 2, 3, 4] ELSE [0] END) AS k FROM g),
m AS (SELECT group_id, tier, k, f.* FROM tiers JOIN f ON folder = tier OR starts_with(folder, concat(tier, '/')) WHERE tier IS NOT NULL QUALIFY k = min(k) OVER (PARTITION BY group_id)),
j AS (SELECT m.*, ref_len, CASE WHEN seg IS NOT NULL AND coalesce(CASE WHEN contains(path, '_PB2') THEN 'PB2' END, CASE WHEN folder = 'IAV/all/HA' THEN 'HA' END) <> seg THEN NULL
WHEN molecule = 'protein' THEN CASE WHEN {RATIO.format(a='(CAST(median_length AS DOUBLE) / ref_len)')} THEN 'protein' END WHEN median_length >= 8000 THEN 'genome' WHEN {RATIO.format(a='(median_length / 3.0 / ref_len)')} THEN 'cds'
WHEN parent = '300' AND 300 >= 1.2 * ref_len AND {RATIO.format(a='(median_length / 3.0 / 300)')} THEN 'subregion' END AS mode FROM m JOIN g USING (group_id))
SELECT g.group_id, CASE WHEN count(path) = 0 THEN 'no folder' WHEN count(mode) = 0 THEN 'no suitable file' ELSE 'planned' END AS status, any_value(tier) AS tier, count(mode) AS suitable, count(path) - count(mode) AS rejected, coalesce(array_to_string(list_sort(list(DISTINCT concat(mode, CASE WHEN state = 'aligned' THEN '_aligned' WHEN mode = 'protein' THEN '_raw' ELSE '' END)) FILTER (WHERE mode IS NOT NULL)), ';'), '') AS modes FROM g LEFT JOIN j USING (group_id) GROUP BY g.group_id"""


@query(PLAN_SQL)
def task_routes(spark, sf_dir):
    """Which files serve which group, and why others don't."""
    t(spark, sf_dir, "supplier").createOrReplaceTempView("supplier")
    g = grouping.groups(grouping.usable(nations(spark, sf_dir)))
    from tidemark.plans import routing

    routed = routing.route(g, spark.sql(STOCK))
    facts = routed.groupBy("group_id").agg(F.first("tier").alias("tier"), F.count("mode").alias("suitable"), (F.count("path") - F.count("mode")).alias("rejected"), F.array_join(F.array_sort(F.collect_set("mode")), ";").alias("modes"))
    out = routing.plan_status(g, routed).join(facts, "group_id", "left")
    return out.select("group_id", "status", "tier", F.coalesce("suitable", F.lit(0)).alias("suitable"), F.coalesce("rejected", F.lit(0)).alias("rejected"), F.coalesce("modes", F.lit("")).alias("modes"))


def plan_file(spark, sf_dir) -> str:
    """The task plan as a document, with the groups' configurations."""
    planned, skipped, blocked, _ = decided(spark, sf_dir)
    path = folder(spark, "task_plan.json")
    disk = t(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.replace("n_name", F.lit(" "), F.lit("_")), F.lit(".csv")).alias("benchmark_file"))
    taskplan.write_configs(spark, planned, f"{path}-configs")
    files.write_json(taskplan.document(planned, skipped, blocked, disk, "r.csv", "i.json", f"{path}-configs"), path)
    return path


@query(f"""WITH p AS ({PLAN_SQL}), g AS ({GROUP_SQL}), b AS (SELECT group_id, status, unnest(string_split(benchmarks, ';')) AS benchmark_file FROM g JOIN p USING (group_id))
SELECT benchmark_file, 'planned' AS kind, CASE WHEN n % 2 = 0 THEN '' ELSE 'missing' END AS note FROM b JOIN (SELECT concat(replace(n_name, ' ', '_'), '.csv') AS benchmark_file, n_nationkey AS n FROM nation) USING (benchmark_file) WHERE status = 'planned'
UNION ALL SELECT benchmark_file, 'skipped', status FROM b WHERE status <> 'planned' UNION ALL SELECT benchmark_file, 'skipped', 'empty target_seq' FROM ({NATIONS}) WHERE target_seq = ''
UNION ALL SELECT benchmark_file, 'blocked', '' FROM ({NATIONS}) WHERE target_seq <> '' AND recommended_reference = 'full_protein_plus_motif' AND full_protein_seq = ''""")
def task_plan(spark, sf_dir):
    """What the plan says of each benchmark; written as a document, read back."""
    path = plan_file(spark, sf_dir)
    doc = spark.read.schema(tables.PLAN).json(path, multiLine=True)
    missing = doc.select(F.explode("dms_missing_on_disk").alias("benchmark_file")).withColumn("m", F.lit("missing"))
    planned = tables.read_plan(spark, path).select(F.explode("benchmarks").alias("benchmark_file"), F.lit("planned").alias("kind")).join(missing, "benchmark_file", "left").select("benchmark_file", "kind", F.coalesce("m", F.lit("")).alias("note"))
    why = F.when(F.startswith("reason", F.lit("no FASTA folder")), "no folder").when(F.startswith("reason", F.lit("folder '")), "no suitable file").otherwise(F.col("reason"))
    skipped = doc.select(F.explode("skipped").alias("s")).select("s.benchmark_file", F.lit("skipped").alias("kind"), F.col("s.reason").alias("reason")).select("benchmark_file", "kind", why.alias("note"))
    blocked = doc.select(F.explode("blocked").alias("s")).select("s.benchmark_file", F.lit("blocked").alias("kind"), F.lit("").alias("note"))
    return planned.union(skipped).union(blocked)


@query(f"WITH p AS ({PLAN_SQL}) SELECT group_id, CAST(suitable - CASE WHEN contains(group_id, 'IAV') THEN 1 ELSE 0 END AS BIGINT) AS files FROM p WHERE status = 'planned' AND suitable - CASE WHEN contains(group_id, 'IAV') THEN 1 ELSE 0 END > 0")
def plan_pending(spark, sf_dir):
    """Files of the plan that are left to do; of each influenza group the first is done."""
    left = taskplan.pending(tables.read_plan(spark, plan_file(spark, sf_dir)))
    done = schedule.only(left, "IAV").groupBy("group_id").agg(F.min("chunk").alias("chunk"))
    return schedule.unfinished(left, done, ["group_id", "chunk"]).groupBy("group_id").agg(F.count("*").alias("files"))


@query(f"WITH p AS ({PLAN_SQL}) SELECT group_id, h AS ref_hash, CAST(ref_len AS INT) AS ref_len, CAST(motifs AS INT) AS tags FROM ({GROUP_SQL}) JOIN p USING (group_id) WHERE status = 'planned' UNION ALL SELECT NULL, NULL, NULL, -1")
def manifests(spark, sf_dir):
    """A manifest per planned group and a broken one, written and read."""
    top = folder(spark, "aligned")
    catalogue.write_manifests(spark, tables.read_plan(spark, plan_file(spark, sf_dir)), top)
    files.write_text(spark, f"{top}/broken/{catalogue.MANIFEST}", "{not json")
    return catalogue.read_manifests(spark, top).select("group_id", "ref_hash", "ref_len", F.coalesce(F.when(F.col("motif_tags").isNotNull(), F.size("motif_tags")), F.lit(-1)).alias("tags"))


CHUNK = "concat('g', doc_id % 7, '/c', doc_id % 11, '/', CASE doc_id % 5 WHEN 0 THEN '.msa_complete' WHEN 1 THEN concat('c', doc_id % 11, '_aligned_proteins.fasta/part-0') WHEN 2 THEN concat('c', doc_id % 11, '_A_b', doc_id % 2, '_counts_by_year_wide.csv') WHEN 3 THEN 'c.log' ELSE 'deep/c_counts_by_month_wide.csv' END)"


@query(f"""SELECT folder, chunk, bool_or(contains(path, '/.msa_complete')) AS msa_complete, bool_or(contains(path, '_aligned_proteins')) AS aligned_proteins, bool_or(contains(path, '/.msa_complete')) AND bool_or(contains(path, '_aligned_proteins')) AS reusable,
coalesce(array_to_string(list_sort(list(DISTINCT CASE WHEN contains(path, '_A_b') THEN concat('A_b', doc_id % 2) ELSE '' END) FILTER (WHERE contains(path, '_A_b'))), ';'), '') AS tags FROM (SELECT doc_id, concat('g', doc_id % 7) AS folder, concat('c', doc_id % 11) AS chunk, {CHUNK} AS path FROM documents WHERE doc_id % 5 < 4) GROUP BY folder, chunk""")
def chunk_probe(spark, sf_dir):
    listed = t(spark, sf_dir, "documents").where("doc_id % 5 < 4").select(F.expr(CHUNK).alias("path"), F.lit(1).alias("size_bytes"))
    return catalogue.probe(listed).select("folder", "chunk", "msa_complete", "aligned_proteins", "reusable", F.array_join(F.array_sort(F.map_keys("counts_by_motif")), ";").alias("tags"))


@query(f"""SELECT concat((SELECT arg_max(virus_code, ordinal) FROM ({NATIONS}) WHERE replace(target_seq, '-', '') = repeat('MKT', 21)), '_63aa_', substr(sha1(repeat('MKT', 21)), 1, 8)) AS group_id, 'm' AS tag, benchmark_file FROM ({NATIONS}) WHERE replace(target_seq, '-', '') = repeat('MKT', 22)""")
def register_alignment(spark, sf_dir):
    """A folder that was aligned elsewhere: its canonical group, and the benchmarks whose targets its motifs are."""
    group, matches = catalogue.register(nations(spark, sf_dir), "MKT" * 21, {"m": "MKT" * 22, "other": "W"})
    return matches.crossJoin(group).select("group_id", "tag", "benchmark_file")  # a group is one row


RUN_SEQ = f"(SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS dataset, CASE doc_id % 3 WHEN 0 THEN rpad(substr(nt, 1, 30), 33, '-') WHEN 1 THEN '{CODONS}' ELSE nt END AS seq, doc_id % 4 AS y FROM (SELECT doc_id, {NT_SQL} AS nt FROM documents))"


@query(f"""WITH s AS (SELECT dataset, CASE dataset WHEN 'c' THEN 'FAILED' ELSE 'OK' END AS status, count(*) AS n, count(DISTINCT replace(seq, '-', '')) AS variants, count(*) FILTER (WHERE y = 0) AS u FROM {RUN_SEQ} GROUP BY dataset),
r AS (SELECT dataset, status, CASE WHEN dataset <> 'c' THEN n END AS input_sequences, CASE WHEN dataset = 'b' THEN n END AS cds_in, CASE WHEN dataset = 'b' THEN n END AS cds_kept, CASE WHEN dataset = 'b' THEN 0 END AS cds_dropped_short, CASE WHEN dataset = 'b' THEN n END AS aligned,
CASE WHEN dataset = 'b' THEN n END AS motif_kept, CASE WHEN dataset <> 'c' THEN n END AS counted_records, CASE WHEN dataset = 'b' THEN 1 WHEN dataset = 'a' THEN variants END AS unique_variants, CASE WHEN dataset <> 'c' THEN u END AS unknown_date FROM s)
SELECT dataset, status, CAST(input_sequences AS BIGINT) AS input_sequences, CAST(cds_in AS BIGINT) AS cds_in, CAST(cds_kept AS BIGINT) AS cds_kept, CAST(cds_dropped_short AS BIGINT) AS cds_dropped_short, CAST(aligned AS BIGINT) AS aligned, CAST(motif_kept AS BIGINT) AS motif_kept, CAST(counted_records AS BIGINT) AS counted_records, CAST(unique_variants AS BIGINT) AS unique_variants, CAST(unknown_date AS BIGINT) AS unknown_date FROM (
SELECT * FROM r UNION ALL SELECT 'TOTAL', NULL, sum(input_sequences), sum(cds_in), sum(cds_kept), sum(cds_dropped_short), sum(aligned), sum(motif_kept), sum(counted_records), sum(unique_variants), sum(unknown_date) FROM r)""")
def run_summary(spark, sf_dir):
    """A run over three datasets: aligned nucleotides, genes with a motif, and one that fails; stage counters and total."""
    d = coding_documents(spark, sf_dir)
    name = F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b").otherwise("c")
    seq = F.when(F.col("doc_id") % 3 == 0, F.rpad(F.substring("nt", 1, 30), 33, "-")).when(F.col("doc_id") % 3 == 1, CODONS).otherwise(F.col("nt"))
    date = F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("|20"), (18 + F.col("doc_id") % 4).cast("string"), F.lit("-0"), (1 + F.col("doc_id") % 9).cast("string")))
    top = as_files(d.select(F.concat(name, F.lit(".fasta")).alias("path"), F.col("doc_id").alias("place"), F.concat(F.lit("r"), date).alias("description"), seq.alias("seq")), folder(spark, "input"))
    files.write_text(spark, f"{top}/a.txt", f">protein_reference\n{REFERENCE}\n")
    files.write_text(spark, f"{top}/b.txt", f">protein_reference\n{REFERENCE}\n>motif_reference\n{REFERENCE[3:9]}\n")
    files.write_text(spark, f"{top}/reference.txt", f">motif_reference\n{REFERENCE[3:9]}\n")
    table = runs.run(spark, top, f"{top}-output", runs.Options(start_year=2019))
    return table.select("dataset", "status", "input_sequences", "cds_in", "cds_kept", "cds_dropped_short", "aligned", "motif_kept", "counted_records", "unique_variants", "unknown_date")


WRITTEN_GENE = f"concat(substr('{CODONS}', 1, 14), CASE WHEN doc_id % 2 = 0 THEN 'T' ELSE 'C' END, substr('{CODONS}', 16))"
WRITTEN_SQL = f"(SELECT concat('r', doc_id, '|', 2018 + doc_id % 4, '-0', 1 + doc_id % 9) AS d, 1 + doc_id % 3 AS frame, {WRITTEN_GENE} AS g FROM documents)"


def written_sql() -> str:
    """The records of each file that a run over a folder of genomes and one of genes writes."""
    notes = {"genomes": "concat(d, ' [orf_aa=34] [frame +', frame, '] [kmer_score=1.00]')", "genes": "concat(d, ' [cds_aa=34] [frame +1]')"}
    out = []
    for dataset, note in notes.items():
        for step, aa, nt in (("orf", REFERENCE, "g"), ("aligned", REFERENCE, "g"), ("motif", REFERENCE[3:9], "substr(g, 10, 18)")):
            if (dataset, step) != ("genes", "orf"):
                out += [f"SELECT '{dataset}_{step}_proteins.fasta' AS file, {note} AS description, '{aa}' AS seq FROM {WRITTEN_SQL}", f"SELECT '{dataset}_{step}_nucleotides.fasta', {note}, {nt} FROM {WRITTEN_SQL}"]
    return " UNION ALL ".join(out)


@query(written_sql())
def written_fasta(spark, sf_dir):
    """The FASTA files that runs write, read back: coding regions, alignments and motif fragments, with what was found in each header."""
    d = coding_documents(spark, sf_dir).withColumn("gene", F.expr(WRITTEN_GENE))
    genome = F.concat(F.repeat(F.lit("C"), (F.col("doc_id") % 3).cast("int")), F.lit("TAA"), "gene", F.lit("TAA"), "nt")
    head = F.expr("concat('r', doc_id, '|', 2018 + doc_id % 4, '-0', 1 + doc_id % 9)")
    each = [d.select(F.lit(f"{name}.fasta").alias("path"), F.col("doc_id").alias("place"), head.alias("description"), seq.alias("seq")) for name, seq in (("genomes", genome), ("genes", F.col("gene")))]
    top = as_files(each[0].unionByName(each[1]), folder(spark, "input"))
    runs.run(spark, top, f"{top}-output", runs.Options(), config_text=f">protein_reference\n{REFERENCE}\n>motif_reference\n{REFERENCE[3:9]}\n")
    made = [f"{top}-output/{name}/{f}" for name in ("genomes", "genes") for f in files.folders(spark, f"{top}-output/{name}") if f.endswith(".fasta")]
    return fasta.read_fasta(spark, made).select(F.element_at(F.split("file_path", "/"), -2).alias("file"), "description", "seq")


@query(f"SELECT infix, nt, aa, year, month, CAST(sum(n) AS BIGINT) AS n FROM (SELECT '_' || nt AS infix, nt, aa, year, month, n FROM ({ORDERS_SQL}) UNION ALL SELECT '_' || nt, nt, aa, year, month, n FROM ({LINES_SQL}) WHERE nt <> 'R') GROUP BY ALL")
def integrated_datasets(spark, sf_dir):
    """Sums over datasets kept up to date in three steps: two datasets, then one changed and one added, then one gone."""
    top = folder(spark, "output")

    def give(dataset: str, rows: DataFrame) -> None:
        long = counts.count_variants(rows).select(F.concat(F.lit("_"), "nt").alias("infix"), F.lit("m").alias("motif_tag"), "nt", "aa", "year", "month", "n")
        long.write.mode("overwrite").parquet(f"{top}/{dataset}/{integration.STORE}/count={dataset}")

    give("a", orders(spark, sf_dir).where("nt <> 'P'"))
    give("gone", lines(spark, sf_dir))
    integration.update(spark, top)
    give("a", orders(spark, sf_dir))
    give("b", lines(spark, sf_dir).where("nt <> 'R'"))
    integration.update(spark, top)
    files.delete(spark, f"{top}/gone")
    integration.update(spark, top)
    return integration.sums(spark, top)


@query(f"SELECT nt, aa, CAST(year AS INT) AS year, CAST(month AS INT) AS month, count(*) AS n FROM (SELECT nt, {translate_sql('nt')} AS aa, 2018 + doc_id % 4 AS year, 1 + doc_id % 9 AS month FROM (SELECT doc_id, substr({NT_SQL}, 1, 6) AS nt FROM documents)) GROUP BY ALL")
def fasta_stream(spark, sf_dir):
    """A folder of FASTA files that grows in three steps, each counted as it comes and compacted."""
    top, d = folder(spark, "incoming"), coding_documents(spark, sf_dir)
    head = F.expr("concat('r', doc_id, '|', 2018 + doc_id % 4, '-0', 1 + doc_id % 9)")
    rows = d.select(F.concat(F.lit("s"), F.col("doc_id") % 20, F.lit(".Fa")).alias("path"), F.col("doc_id").alias("place"), head.alias("description"), F.col("nt").alias("seq"))

    def to_fragments(records: DataFrame) -> DataFrame:
        return pipeline.dated(records).withColumn("nt", F.substring("seq", 1, 6)).withColumn("aa", sequences.translate("nt"))

    for step in range(3):
        as_files(rows.where(F.col("place") % 3 == step), f"{top}/step{step}")
        found = incremental.count_folder(spark, top, to_fragments, f"{top}-counts", f"{top}-state", files_per_batch=7, beyond=1)
    return found


@query("SELECT 'FAILED' AS status, 'nothing to count: no record came through for motif m' AS error")
def nothing_to_count(spark, sf_dir):
    """A run of which no fragment is left is an error."""
    k = F.col("r_regionkey")
    seq = F.concat(F.lit("MK"), F.repeat(F.lit("-"), k), F.substring(F.lit("AYIAK"), k + 1, F.lit(1)), F.repeat(F.lit("-"), 4 - k))  # one residue of the motif each
    rows = t(spark, sf_dir, "region").select(F.lit("a.fa").alias("path"), k.alias("place"), F.lit("r").alias("description"), seq.alias("seq"))
    table = runs.run(spark, as_files(rows, folder(spark, "input")), folder(spark, "output"), config_text=">motif_reference_m\nAYIAK\n")
    return table.where("dataset = 'a'").select("status", "error")


@query(f"SELECT nt, aa, bin, CAST(sum(n) AS BIGINT) AS n FROM (SELECT nt, aa, n, {YEARLY.format(s=1997)} AS bin FROM ({LINES_SQL})) GROUP BY nt, aa, bin")
def wide_files(spark, sf_dir):
    """Count tables of two chunks, written as files by the naming rule, found again and summed."""
    top = folder(spark, "aligned")
    long = counts.count_variants(lines(spark, sf_dir))
    for chunk, part in (("c1", long.where("aa = 'O'")), ("c2", long.where("aa <> 'O'"))):
        (_, _, _, table), = runs.names(chunk, [], False)
        files.write_csv(counts.rename_keys(counts.most_counted(counts.wide_counts(part, start=1997, end=2001))), f"{top}/g/{chunk}/{chunk}/{table}")
    return training.chunk_counts(spark, found_chunks(spark, top)).groupBy("nt", "aa", "bin").agg(F.sum("n").alias("n"))


def found_chunks(spark, top: str) -> DataFrame:
    chunks = catalogue.probe(catalogue.listing(spark, top))
    return chunks.withColumn("counts_by_motif", F.transform_values("counts_by_motif", lambda _, p: F.concat(F.lit(top + "/"), p)))


#: Counts of a planned group's chunks: peptides with gaps, years before the virus' first.
VARIANTS = "SELECT concat('c', o_custkey % 3) AS chunk, o_orderpriority AS nt, CASE WHEN o_custkey % 4 = 0 THEN 'MK-X' WHEN o_custkey % 4 = 1 THEN '' ELSE concat('MKTAYIAKQ', substr(o_orderpriority, 1, 1)) END AS aa, CAST(year(o_orderdate) + 20 AS INT) AS year FROM orders"
SUMMED = f"SELECT nt, aa, CASE WHEN year BETWEEN 2019 AND year(current_date) + 1 THEN CAST(year AS VARCHAR) ELSE 'unknown' END AS bin, count(*) AS n FROM ({VARIANTS}) WHERE aa <> '' GROUP BY ALL"


def planned_counts(spark, sf_dir):
    """A plan of two motifs, and the chunks in which the first is counted."""
    t(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    rows, top = spark.sql(VARIANTS).withColumn("month", F.lit(None).cast("int")), folder(spark, "aligned")
    for k in range(3):
        long = counts.count_variants(rows.where(F.col("chunk") == f"c{k}"))
        files.write_csv(counts.rename_keys(counts.wide_counts(long, start=2016, end=2021)), f"{top}/SCV2_4aa_x/c{k}/c{k}_m.1_counts_by_year_wide.csv".replace("m.1", "m_1"))
    plan = spark.createDataFrame([("SCV2_4aa_x", "SCV2", "yearly", [("m.1", 4, ["a.csv", "b.csv"]), ("none", 2, ["z.csv"])])], "group_id string, virus_code string, binning string, motifs array<struct<tag:string,len:int,benchmarks:array<string>>>")
    return plan, found_chunks(spark, top), f"{top}-training"


AUDIT_SQL = f"""SELECT 'SCV2_4aa_x' AS group_id, 'm_1' AS motif_tag, 'a.csv;b.csv' AS benchmarks, (SELECT count(DISTINCT chunk) FROM ({VARIANTS})) AS chunks_merged, count(DISTINCT (nt, aa)) FILTER (WHERE aa <> 'MK-X') AS variants_kept, count(DISTINCT (nt, aa)) FILTER (WHERE aa = 'MK-X') AS "variants_dropped_gapX",
CAST(coalesce(sum(n) FILTER (WHERE aa <> 'MK-X'), 0) AS BIGINT) AS counts_kept, CAST(coalesce(sum(n) FILTER (WHERE aa = 'MK-X'), 0) AS BIGINT) AS "counts_dropped_gapX", CAST(coalesce(sum(n) FILTER (WHERE bin = 'unknown'), 0) AS BIGINT) AS counts_unknown, concat(min(bin) FILTER (WHERE bin <> 'unknown'), '..', max(bin) FILTER (WHERE bin <> 'unknown')) AS date_range, 'OK' AS status FROM ({SUMMED})
UNION ALL SELECT 'SCV2_4aa_x', 'none', 'z.csv', 0, 0, 0, 0, 0, 0, '', 'no count files yet'"""


@query(AUDIT_SQL)
def training_audit(spark, sf_dir):
    """Training tables of a plan, and their summary."""
    return training.aggregate(spark, *planned_counts(spark, sf_dir))


@query(f"""SELECT benchmark, nt, aa, CAST(total AS BIGINT) AS total, CAST(row_number() OVER (PARTITION BY benchmark ORDER BY total DESC, nt, aa) AS BIGINT) AS place FROM (SELECT nt, aa, sum(n) AS total FROM ({SUMMED}) WHERE aa <> 'MK-X' GROUP BY nt, aa), (VALUES ('a'), ('b')) AS v(benchmark)""")
def training_order(spark, sf_dir):
    """Rows of the training tables as written, the most counted first."""
    plan, chunks, out = planned_counts(spark, sf_dir)
    training.aggregate(spark, plan, chunks, out)
    rows = None
    for b in "ab":
        raw = spark.read.option("header", "true").csv(f"{out}/{b}_training_counts.csv")
        bins = [c for c in raw.columns if c not in (tables.NT, tables.AA)]
        one = raw.select(F.lit(b).alias("benchmark"), F.col(tables.NT).alias("nt"), F.col(tables.AA).alias("aa"), sum((F.col(f"`{c}`").cast("long") for c in bins), F.lit(0).cast("long")).alias("total"), (F.monotonically_increasing_id() + 1).alias("place"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


INTEGRATED = "SELECT '_' || nt AS infix, * FROM ({rows})"


@query(f"""WITH c AS ({INTEGRATED.format(rows=ORDERS_SQL)} UNION ALL {INTEGRATED.format(rows=LINES_SQL)}), b AS (SELECT infix, nt, aa, {YEARLY.format(s=1993)} AS bin, n FROM c)
SELECT infix, bin, nt, aa, CAST(sum(n) AS BIGINT) AS n, CAST(dense_rank() OVER (PARTITION BY infix ORDER BY t DESC, nt, aa) AS BIGINT) AS place FROM (SELECT *, sum(n) OVER (PARTITION BY infix, nt, aa) AS t FROM b) GROUP BY infix, bin, nt, aa, t""")
def integrated_files(spark, sf_dir):
    """The integrated tables of two datasets as files, all from one job: their counts, and the places of their rows."""
    top = folder(spark, "output")
    for dataset, rows in (("a", orders(spark, sf_dir)), ("b", lines(spark, sf_dir))):
        long = counts.count_variants(rows).select(F.concat(F.lit("_"), "nt").alias("infix"), F.lit("m").alias("motif_tag"), "nt", "aa", "year", "month", "n")
        long.write.parquet(f"{top}/{dataset}/{integration.STORE}/count={dataset}")
    made = runs.integrate(spark, top, runs.Options(start_year=1993))
    infix = F.regexp_extract("path", r"integrated(.*)_counts_by_year_wide\.csv$", 1).alias("infix")
    found = tables.read_wide_tables(spark, made).select(infix, "bin", "nt", "aa", "n")
    lines_ = spark.read.text(made).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), F.split("value", ",").alias("c"))
    placed = lines_.select(infix, F.get("c", F.lit(0)).alias("nt"), F.get("c", F.lit(1)).alias("aa"), F.row_number().over(Window.partitionBy("path").orderBy("at")).cast("long").alias("line"))
    return found.join(placed.select("infix", "nt", "aa", (F.col("line") - 1).alias("place")), ["infix", "nt", "aa"])


@query("SELECT concat(replace(n_name, ' ', '_'), '.csv') AS benchmark_file FROM nation WHERE n_nationkey % 3 > 0")
def listed_benchmarks(spark, sf_dir):
    """The benchmarks that lie in a folder, beside their registry and files of another kind."""
    name = F.concat(F.replace("n_name", F.lit(" "), F.lit("_")), F.when(F.col("n_nationkey") % 3 > 0, ".csv").otherwise(".txt"))
    rows = t(spark, sf_dir, "nation").select(name.alias("path"), F.col("n_nationkey").alias("place"), F.lit("x").alias("description"), F.lit("A").alias("seq"))
    top = as_files(rows, folder(spark, "benchmarks"))
    files.write_text(spark, f"{top}/registry.csv", "benchmark_file\n")
    return tables.list_benchmarks(spark, top, "registry.csv")


@query(f"""WITH p AS ({PLAN_SQL}) SELECT group_id, 'protein' AS tag, any_value(reference) AS seq FROM (SELECT concat(arg_min(virus_code, ordinal), '_', any_value(length(reference)), 'aa_', h) AS group_id, any_value(reference) AS reference FROM ({GROUPED}) GROUP BY h) JOIN p USING (group_id) WHERE status = 'planned' GROUP BY group_id
UNION ALL SELECT DISTINCT group_id, md5(target), target FROM (SELECT h, target FROM ({GROUPED})) JOIN ({GROUP_SQL}) USING (h) JOIN p USING (group_id) WHERE status = 'planned'""")
def group_configs(spark, sf_dir):
    """The configurations that a plan writes, read by both readers: the protein and the motifs of each group."""
    path, rows = plan_file(spark, sf_dir), []
    for g in tables.read_plan(spark, path).select("group_id", "config").toLocalIterator():
        text = files.read_text(spark, g.config)
        c, (protein, loose) = config.parse(text), config.parse_loosely(text)
        assert protein == c.protein and sorted(loose.values()) == sorted("+".join(m.parts) for m in c.motifs)
        rows += [(g.group_id, "protein", protein), *((g.group_id, None, m) for m in loose.values())]
    return spark.createDataFrame(rows, "group_id string, tag string, seq string").withColumn("tag", F.coalesce("tag", F.md5(F.col("seq").cast("binary"))))


@query("""SELECT concat('g', doc_id % 3) AS group_id, concat('c', doc_id % 7) AS chunk, doc_id % 3 + doc_id % 7 < 5 AS msa_complete, bool_or(doc_id % 2 = 0) AS aligned_proteins, doc_id % 3 + doc_id % 7 < 5 AND bool_or(doc_id % 2 = 0) AS reusable, true AS registered FROM documents WHERE doc_id % 3 < 2 GROUP BY doc_id % 3, doc_id % 7
UNION ALL SELECT 'g2', NULL, NULL, NULL, NULL, false""")
def aligned_catalogue(spark, sf_dir):
    """The catalogue document of a folder of alignments: chunks with their markers, and a folder without a manifest."""
    file = F.expr("concat('g', doc_id % 3, '/c', doc_id % 7, '/c', doc_id % 7, CASE WHEN doc_id % 2 = 0 THEN '_aligned_proteins.fasta' ELSE '_orf_proteins.fasta' END)")
    rows = coding_documents(spark, sf_dir).select(file.alias("path"), F.col("doc_id").alias("place"), F.lit("x").alias("description"), F.col("nt").alias("seq"))
    top = as_files(rows, folder(spark, "aligned"))
    made = spark.createDataFrame([(f"g{k}", 4, "c.txt", [("m",)]) for k in range(2)], "group_id string, ref_len int, config string, motifs array<struct<tag:string>>")
    catalogue.write_manifests(spark, made, top)
    for g in files.folders(spark, top):
        for c in files.folders(spark, f"{top}/{g}"):
            if int(g[1:]) + int(c[1:]) < 5:
                runs.finish(spark, f"{top}/{g}/{c}")
    files.write_json(catalogue.document(spark, top), f"{top}-inventory.json")
    entry = "folder string, ref_hash string, chunks map<string, struct<msa_complete boolean, aligned_proteins boolean, reusable boolean>>"
    doc = spark.read.schema(f"groups map<string, struct<{entry}>>, unregistered_folders array<string>").json(f"{top}-inventory.json")
    chunks = doc.select(F.explode("groups").alias("group_id", "g")).select("group_id", F.explode("g.chunks").alias("chunk", "e")).select("group_id", "chunk", "e.*", F.lit(True).alias("registered"))
    rest = doc.select(F.explode("unregistered_folders").alias("group_id"), F.lit(False).alias("registered"))
    return chunks.unionByName(rest, allowMissingColumns=True)


@query(f"SELECT path AS rel_path, CAST(row_number() OVER (ORDER BY path) - 1 AS INT) AS place FROM (SELECT DISTINCT path FROM {SEQ_SQL})")
def inventory_order(spark, sf_dir):
    """The places of files in the inventory document."""
    root = fasta_folder(spark, sf_dir)
    files.write_json(inventory.document(inventory.scan(spark, root, 1), root, 1), f"{root}-inventory.json")
    doc = spark.read.schema(tables.INVENTORY).json(f"{root}-inventory.json", multiLine=True)
    return doc.select(F.posexplode("files").alias("place", "f")).select("f.rel_path", "place")


@query(f"SELECT p_partkey, '{REFERENCE}' AS aln_aa FROM part WHERE 34 + p_partkey % 60 * 15 <= {align.longest_query(34)}")
def over_long_peptides(spark, sf_dir):
    """Peptides that are too long for their reference are left out; the reference itself is no row of the alignment."""
    aa = F.concat(F.lit(REFERENCE), F.repeat(F.lit("G"), (F.col("p_partkey") % 60 * 15).cast("int")))
    rows = t(spark, sf_dir, "part").select("p_partkey", aa.alias("aa"))
    return align.align_to_reference(rows, REFERENCE, nt=None, apart=("p_partkey",)).select("p_partkey", "aln_aa")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 20")
def open_chunks(spark, sf_dir):
    """The first 20 of what is left to do, as a report shows them."""
    return schedule.unfinished(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id").orderBy("doc_id").limit(20)


