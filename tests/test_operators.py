import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sequences
from tidemark.operators import align, coding, counts, motif, profile


def peptide(nt):
    """By the table of the standard code, codon by codon."""
    code = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG", strict=True))
    return "".join(code.get(nt[k : k + 3], "X") for k in range(0, len(nt) - 2, 3))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_upper_median_and_profiles(spark):
    df = spark.createDataFrame([("a", "ACGT"), ("a", "AC-T"), ("b", "MKLF"), ("b", "MK"), ("c", "ACGTX"), ("c", "ACGTA")], "f string, seq string")
    got = {r.f: r for r in profile.engine_profile(df, ["f"]).collect()}
    assert (got["a"].molecule, got["a"].aligned, got["b"].molecule, got["b"].median_len, got["c"].molecule) == ("nucleotide", True, "protein", 4, "protein")
    scan = {r.f: (r.molecule, r.state) for r in profile.scanner_profile(df, ["f"]).collect()}
    assert scan == {"a": ("nucleotide", "aligned"), "b": ("protein", "raw"), "c": ("protein", "raw")}
    four = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n int")
    assert four.agg(profile.upper_median("n").alias("m")).first().m == 3
    assert profile.is_genome(30000, 300) and not profile.is_genome(900, 300)


def test_cds(spark):
    rng = random.Random(2)
    seqs = ["AT", "", "ATGTAA", *("".join(rng.choice("ACGT") for _ in range(rng.randint(3, 60))) for _ in range(80))]
    got = {r.id: (r.frame, r.aa, r.nt) for r in coding.translate_cds(spark.createDataFrame(list(enumerate(seqs)), "id int, seq string"), 2).collect()}
    for i, s in enumerate(seqs):
        frames = [(aa.count("*"), -max(map(len, aa.split("*"))), f, aa.split("*")[0]) for f in range(3) if len(s) >= f + 3 for aa in [peptide(s[f:])]]
        best = min(frames, default=None)
        assert got.get(i, (None,))[:2] == ((best[2], best[3]) if best and len(best[3]) >= 2 else (None,)), s
        assert i not in got or peptide(got[i][2]) == got[i][1]
    assert coding.least_length(11) == 5 and coding.least_length(1) == 1 and coding.least_length(9, given=3) == 3


def brute_orf(seq, reference, least):
    """(frame, aa, nt, score) by all segments of all frames."""
    def kmers(p):
        return {p[i : i + 10] for i in range(len(p) - 9) if "X" not in p[i : i + 10]}

    known, best, seq = kmers(reference), None, (seq or "").upper()
    for frame in range(3):
        at = frame
        for p in peptide(seq[frame:]).split("*"):
            if known and len(p) >= least:
                score = len(kmers(p) & known) / len(known)
                if score >= 0.3 and (best is None or score > best[3]):
                    best = frame, p, seq[at : at + 3 * len(p)], score
            at += 3 * len(p) + 3
    return best


def test_orfs_match_brute_force(spark):
    rng = random.Random(5)

    def bases(n):
        return "".join(rng.choice("ACGT") for _ in range(n))

    gene = bases(240).replace("TAA", "TCA").replace("TAG", "TCG").replace("TGA", "TCA")
    reference = max(peptide(gene).split("*"), key=len)
    seqs = ["C" * k + gene + "TAA" + bases(60) for k in range(4)] + ["ACGT" * 20, "", None, "AC"]
    for _ in range(60):  # parts of the gene, in any frame, with changed bases and stops before and behind
        a, b = sorted(rng.sample(range(len(gene)), 2))
        part = list(gene[a:b])
        for _ in range(rng.randint(0, 3)):
            if part:
                part[rng.randrange(len(part))] = rng.choice("ACGTN")
        seqs.append(bases(rng.randint(0, 40)) + "".join(part) + bases(rng.randint(0, 40)) + (gene.lower() if rng.random() < 0.3 else ""))
    df = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string")
    got = {r.id: (r.frame, r.aa, r.nt, r.score) for r in coding.extract_orfs(df, reference, 12).collect()}
    want = {i: x for i, s in enumerate(seqs) if (x := brute_orf(s, reference, 12))}
    assert got == want and {0, 1, 2, 3} <= set(got) and 4 not in got
    assert coding.extract_orfs(df, "SHORTREF", 20).count() == 0  # no 10-mers: nothing is kept


def test_align_properties(spark):
    reference = "MKTAYIAKQRQISFVKSHFSRQ"
    assert align.align(reference, reference).tolist() == list(range(22))
    assert align.aligned_texts(reference, "GG" + reference + "PP", None)[0] == reference
    assert align.aligned_texts(reference, reference[:8] + reference[11:], None)[0] == reference[:8] + "---" + reference[11:]
    inserted = align.aligned_texts(reference, reference[:10] + "GGGG" + reference[10:], None)[0]
    assert inserted == reference
    assert align.aligned_texts(reference, "", "") == ("-" * 22, "-" * 66)
    changed = reference.replace("Y", "F")
    aa, nt = align.aligned_texts(reference, changed, "AAA" * 21)
    assert aa == changed and nt == "AAA" * 21 + "---"


def plain_paths(reference, query):
    """Best score, last column and places, cell by cell, with the ties that align states."""
    tables = align.Profile(reference).tables
    n, m, low = len(reference), len(query), align.LOW
    q, a = align.coded(query), align.coded(reference)
    cells = {}
    best = (low, -1, 0)
    for i in range(n):
        for j in range(m + 1):
            before = [(cells.get((i - 1, j - 1, s), (low, None))[0] - (align.CLOSE if s else 0), s) for s in (0, 1, 2)]
            start = 0 if i == 0 else -align.END
            top, came = before[0], 0
            gap = max(before[1][0], before[2][0])
            if gap > before[0][0]:
                top, came = (gap,), 2 if before[2][0] > before[1][0] else 1
            if top[0] < start:
                top, came = (start,), 3
            cells[i, j, 0] = (top[0] + int(tables[int(a[i])][q[j - 1]]), came) if j else (low, 3)
        for j in range(m + 1):
            opened, longer = (cells.get((i, j - 1, s), (low, None))[0] - c for s, c in ((0, align.OPEN), (1, align.EXTEND)))
            cells[i, j, 1] = (opened, 0) if opened >= longer else (longer, 1)
            opened, longer = (cells.get((i - 1, j, s), (low, None))[0] - c for s, c in ((0, align.OPEN), (2, align.EXTEND)))
            cells[i, j, 2] = (opened, 0) if opened >= longer else (longer, 2)
        for j in range(1, m + 1):
            best = max(best, (cells[i, j, 0][0] - (0 if i == n - 1 else align.END), i, -j))
    score, i, j = best[0], best[1], -best[2]
    last, places, state = i, [-1] * n, 0
    while state != 3:
        came = cells[i, j, state][1]
        if state == 0:
            places[i], i, j = j - 1, i - 1, j - 1
        elif state == 1:
            j -= 1
        else:
            i -= 1
        state = came
    return score, last, places


def edited(rng, text, letters, edits):
    query = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(query) + 1), rng.random()
        if kind < 0.35:
            query[at:at] = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 5]))]
        elif kind < 0.7:
            del query[at : at + rng.choice([1, 1, 2, 4])]
        elif at < len(query):
            query[at] = rng.choice(letters)
    return "".join(query)


def test_align_is_best():
    """Shifted, repeated, low-complexity and random pairs, alone and in batches, against all paths one by one."""
    rng = random.Random(3)
    for letters in ("MKTAYIQRSFWGX*", "AG", "LIV", "QNS-"):
        reference = "".join(rng.choice(letters) for _ in range(rng.randint(6, 24)))
        queries = [edited(rng, rng.choice(["", "GG", "MK" * 6]) + reference + rng.choice(["", "PP", reference[:9]]), letters, rng.randint(0, 6)) for _ in range(40)]
        queries += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(10)] + [reference[:5], reference[-6:], reference[3:-3], "é" + reference]
        queries = [q for q in queries if q]
        got = align.align_all(align.Profile(reference), queries)
        for q, places in zip(queries, got, strict=True):
            if reference not in q:
                assert places.tolist() == plain_paths(reference, q)[2], (reference, q)
        assert [p.tolist() for p in got] == [align.align(reference, q).tolist() for q in queries]


def test_align_keeps_few_columns_if_memory_is_short(monkeypatch):
    rng = random.Random(5)
    reference = "".join(rng.choice("MKTAYIQRSFLVDENW") for _ in range(90))
    queries = [edited(rng, reference, "MKTAYIQRSF", 6) for _ in range(20)]
    want = [p.tolist() for p in align.align_all(align.Profile(reference), queries)]
    monkeypatch.setattr(align, "WAYS", 1000)
    monkeypatch.setattr(align, "CELLS", 500)
    assert [p.tolist() for p in align.align_all(align.Profile(reference), queries)] == want


def test_a_shifted_stretch_is_found():
    """One residue less at 100 and one more 18 later: of equal length, but not in equal places."""
    rng = random.Random(8)
    reference = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(200))
    query = reference[:100] + reference[101:118] + ("W" if reference[118] != "W" else "C") + reference[118:]
    places = align.align(reference, query).tolist()
    assert len(query) == 200 and places[:99] == list(range(99)) and places[102:117] == list(range(101, 116)) and places[119:] == list(range(119, 200))


def test_long_queries_are_searched_by_words(monkeypatch):
    rng = random.Random(6)
    residues = "ACDEFGHIKLMNPQRSTVWY"
    reference = "".join(rng.choice(residues) for _ in range(300))
    flank = ["".join(rng.choice(residues) for _ in range(3400)) for _ in range(2)]
    near, far = edited(rng, reference, residues, 3), "".join(c if rng.random() < 0.6 else rng.choice(residues) for c in reference)
    queries = [flank[0] + near + flank[1], flank[0] + near + flank[1][:500] + near + flank[1], near + flank[0], flank[1] + near[:280], flank[0] + far + flank[1], flank[0]]
    profile = align.Profile(reference)
    worked, run = [], align._run
    monkeypatch.setattr(align, "_run", lambda p, qs: worked.append(sum(map(len, qs))) or run(p, qs))
    short, got = [], []
    for q in queries:
        got.append(align.align_all(profile, [q])[0].tolist())
        short.append(sum(worked) < len(q))
        worked.clear()
    assert short == [True, True, True, True, False, False]
    monkeypatch.setattr(align, "_guess", lambda *a: None)
    assert got == [p.tolist() for p in align.align_all(profile, queries)]


def test_dedupe_before_align(spark):
    df = spark.createDataFrame([(i, "MKTAYIAK" if i % 2 else "MKTYIAK", "ATG" * 8) for i in range(10)], "id int, aa string, nt string")
    out = align.align_to_reference(df, "MKTAYIAK")
    assert rows(out.select("aln_aa").distinct(), "aln_aa") == [("MKT-YIAK",), ("MKTAYIAK",)]
    assert out.count() == 10 and all(len(r.aln_nt) == 24 for r in out.collect())


def test_records_of_one_peptide_are_dealt_over_tasks(spark):
    """A peptide that all records share is aligned once and joined in many tasks; none is lost or doubled."""
    df = spark.range(3000).select("id", F.when(F.col("id") == 7, "MKTYIAK").otherwise("MKTAYIAK").alias("aa"), F.when(F.col("id") != 8, F.lit("ATG" * 8)).alias("nt"))
    given = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for nt in ("nt", None):
            out = align.align_to_reference(df, "MKTAYIAK", nt=nt, apart=("id",))
            assert set(out.columns) == {"id", "aa", "nt", "aln_aa"} | ({"aln_nt"} if nt else set())
            got = out.withColumn("task", F.spark_partition_id()).collect()
            assert sorted(r.id for r in got) == list(range(3000)) and all(r.aln_aa == ("MKT-YIAK" if r.id == 7 else "MKTAYIAK") for r in got)
            each = [sum(r.task == k for r in got) for k in {r.task for r in got}]
            assert len(each) > 1 and max(each) < 2000
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)


def test_consensus_ties_and_gaps(spark):
    df = spark.createDataFrame([(0, "AC-"), (1, "GC-"), (2, "GT-"), (3, "AT-")], "o int, aln string")
    assert motif.consensus(df, 3, "aln", F.col("o")) == "AC-"
    codons = spark.createDataFrame([(0, "ATG---NNN"), (1, "ATGAAA---"), (2, "CTGAAANNN")], "o int, aln string")
    assert motif.consensus(codons, 3, "aln", F.col("o"), coding=True) == "MKX"


def test_motif_places(spark):
    assert motif.columns_in_reference("M-KTA--YI", ["KT", "YI"]) == [2, 3, 7, 8]
    with pytest.raises(ValueError):
        motif.columns_in_reference("MKTAYI", ["YI", "MK"])
    df = spark.createDataFrame([("f", 2, "-MKTA"), ("f", 1, "AAAAA"), ("f", 3, "MKTA-")], "file_path string, ordinal long, aln_aa string")
    assert motif.columns_in_data(df, ["KT"]) == [2, 3]
    assert motif.place_part("ABCDEFGH", "CDXFGHAB"[:4], 0) == 2
    with pytest.raises(ValueError):
        motif.place_part("AAAAAAAA", "CCCCCCCC", 0)
    assert motif.place_part("AAAAAAAA", "AAAAAACC", 0) == 0
    with pytest.raises(ValueError):
        motif.place_part("AAAAAAAA", "AAAAACCC", 0)


def test_extract(spark):
    df = spark.createDataFrame([(0, "ABCDEFGHIJ"), (1, "-BCDEFGHIJ"), (2, "-BCDEFGHI-"), (3, "*BCDEFGHIJ")], "id int, aln_aa string")
    assert rows(motif.extract(df, list(range(10))), "id") == [(0,), (1,), (3,)]
    nt = spark.createDataFrame([(0, "ATGAAATTT"), (1, "ATGAAA---"), (2, "ATGTAATTT")], "id int, aln_nt string")
    assert rows(motif.extract_codons(nt, [0, 1, 2], least=1.0), "id", "aa") == [(0, "MKF")]
    assert rows(motif.extract_codons(nt, [0, 1], least=0.5), "id", "aa", "nt") == [(0, "MK", "ATGAAA"), (1, "MK", "ATGAAA"), (2, "M*", "ATGTAA")]
    both = spark.createDataFrame([(0, "MK", "ATGAAA"), (1, "MK", "ATG"), (2, "MK", "ATG---")], "id int, aln_aa string, aln_nt string")
    assert rows(motif.extract(both, [0, 1], aln_nt="aln_nt"), "id", "nt") == [(0, "ATGAAA")]


@pytest.fixture
def fragments(spark):
    rng = random.Random(1)
    data = [(rng.choice(["AAA", "CCC", ""]), rng.choice(["K", "P"]), rng.choice([1999, 2000, 2001, None]), rng.choice([1, 12, None])) for _ in range(300)]
    return spark.createDataFrame([(n, a, y, m if y else None) for n, a, y, m in data], "nt string, aa string, year int, month int")


def test_counts_chunked_equal_whole(spark, fragments):
    whole = counts.count_variants(fragments)
    parts = [counts.count_variants(p) for p in fragments.randomSplit([1.0, 1.0, 1.0], 7)]
    assert rows(counts.integrate(parts), *whole.columns) == rows(whole, *whole.columns)
    assert whole.agg(F.sum("n")).first()[0] == 300


@pytest.mark.parametrize("monthly", [True, False])
def test_wide_keeps_every_record(fragments, monthly):
    wide = counts.wide_counts(counts.count_variants(fragments), monthly, start=2000)
    assert wide.agg(F.sum("Count")).first()[0] == 300
    assert ("before 2000" in wide.columns) != monthly and "2001-12" in wide.columns or not monthly


def test_wide_and_back(fragments):
    long = counts.count_variants(fragments)
    wide = counts.wide_counts(long)
    back = counts.merge_bins(counts.from_wide(wide, counts.KEYS), counts.KEYS, False, 1900, 2100)
    direct = long.groupBy("nt", "aa", F.coalesce(F.col("year").cast("string"), F.lit("unknown")).alias("bin")).agg(F.sum("n").alias("n"))
    assert rows(back, "nt", "aa", "bin", "n") == rows(direct, "nt", "aa", "bin", "n")


def test_training_rows_and_total(spark):
    merged = spark.createDataFrame([("a", "K" * 9 + "-", "2020", 3), ("a", "K-", "2020", 4), ("b", "KK", "unknown", 1)], "nt string, aa string, bin string, n long")
    assert rows(counts.training_rows(merged), "nt", "total") == [("a", 3), ("b", 1)]
    total = counts.with_total(spark.createDataFrame([("x", 1, 2.5), ("y", 2, None)], "name string, n int, s double"), "name")
    assert rows(total, "name", "n", "s")[0] == ("TOTAL", 3, 2.5)


def test_with_peptide(spark):
    df = spark.createDataFrame([("AT-G", None), ("atg", "Z")], "nt string, aa string")
    assert rows(counts.with_peptide(df), "nt", "aa") == [("ATG", "M"), ("ATG", "Z")]
    assert sequences.AMINO_ACIDS.count("*") == 3
