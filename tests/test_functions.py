import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, sequences, texts


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, a {kind}" + (f", b {kind}" if rows and isinstance(rows[0], tuple) else ""))
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def model_translate(nt):
    nt = nt.upper()
    table = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), sequences.AMINO_ACIDS, strict=True))
    return "".join(table.get(nt[i : i + 3], "X") for i in range(0, len(nt) - len(nt) % 3, 3))


def random_dna(n, letters="ACGTN", seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_translate(spark):
    rows = ["ATGNNNTAAGG", "AUG", "", "at", "atgtaa", None, *random_dna(200)]
    got = values(spark, rows, sequences.translate("a"))
    assert got[:2] == ["MX*", "X"] and got[5] is None
    assert got == [None if r is None else model_translate(r) for r in rows]


def test_best_frame(spark):
    def model(nt):
        found = []
        for frame in range(3):
            if len(nt) - frame >= 3:
                aa = model_translate(nt[frame:])
                found.append((aa.count("*"), -max(map(len, aa.split("*"))), frame))
        return min(found)[2] if found else None

    rows = ["", "AT", "ATG", *random_dna(200, "ACGT", 1)]
    assert values(spark, rows, sequences.best_frame("a")) == [model(r) for r in rows]


def test_longest_orf(spark):
    got = values(spark, ["MK*ABC*XYZ", "", "**", "AAA"], sequences.longest_orf("a"))
    assert [None if g is None else tuple(g) for g in got] == [("ABC", 3, 6), None, None, ("AAA", 0, 3)]


def test_small_functions(spark):
    assert values(spark, [("ACGT", "AGG"), ("", "A"), ("AAA", "AAA")], sequences.hamming("a", "b")) == [1, 0, 0]
    assert values(spark, [" ac-g.t "], sequences.degap("a")) == ["ACGT"]
    assert values(spark, [" ac-g.t "], sequences.degap("a", upper=False)) == ["acgt"]
    assert values(spark, ["", "A-XQ", "ABCDEFGHI-"], sequences.gap_share("a")) == [1.0, 0.5, 0.1]
    assert values(spark, ["CCCAAA", "AAACCC", "AAAxCCC", "AACCC"], sequences.parts_in_order(["AAA", "CCC"], "a")) == [False, True, True, False]
    assert values(spark, [("ABCDEFGHIJKL", "ABCDEFGHI"), ("ABCDEFGHIJKL", "BCDEFGHIJKX"), ("AAAAAAAAAAAA", "AAAAAAAAAAAAA")], sequences.kmer_coverage("a", "b")) == [0.0, 1.0, 1.0]
    assert values(spark, ["abc"], sequences.reference_hash("a")) == ["a9993e36"]


CASES = [
    ("hCoV-19/USA/XX/2025|EPI_ISL_20125422|2025-07-20", 2025, 7),
    ("2009-08-28|A/Singapore/ON1900/2009|A_/_H3N2|EPI_ISL_122791", 2009, 8),
    ("x|2023-00-00", 2023, None),
    ("x|2023-13-01|2022-05", 2022, 5),
    ("A/x/2009", 2009, None),
    ("abc 2011 [cds_aa=1,273]", 2011, None),
    ("EPI_ISL_2099", None, None),
    ("none", None, None),
    ("x|2023-05-123", 2023, 5),
    ("x|2023-123", 2023, None),
    ("x|2021-2-30", 2021, 2),
    ("y/2010-05", 2010, None),
    ("2020-05-00|z", 2020, 5),
    ("A/ON/1999/2004 (H1)", 2004, None),
    ("20213", None, None),
    ("a| 2021-03 |b|c", 2021, 3),
    ("", None, None),
]


def test_parse_date(spark):
    got = values(spark, [c[0] for c in CASES], dates.parse_date("a"))
    assert [tuple(g) for g in got] == [c[1:] for c in CASES]


def test_labels(spark):
    df = spark.createDataFrame([(0, 1999, 5), (1, 2000, None), (2, 2001, 12), (3, None, None)], "i int, year int, month int").orderBy("i")
    assert [r.v for r in df.select(dates.yearly_label("year", 2000).alias("v")).collect()] == ["before 2000", "2000", "2001", "unknown"]
    assert [r.v for r in df.select(dates.monthly_label("year", "month", 2000).alias("v")).collect()] == ["unknown", "2000-unknown", "2001-12", "unknown"]
    assert dates.calendar(2000, 2001, False) == ["before 2000", "2000", "2001", "unknown"]
    assert dates.calendar(2000, 2000, True) == [*(f"2000-{m:02d}" for m in range(1, 13)), "2000-unknown", "unknown"]
    assert dates.calendar(2002, 2001, True) == ["unknown"]
    assert sorted(["Count", "unknown", "2020-unknown", "2020-12", "before 2000"], key=dates.label_order) == ["before 2000", "2020-12", "2020-unknown", "unknown", "Count"]
    labels = ["2018", "2019", "2024", "20213", "1953-unknown", "NA", "2020-05", "Count"]
    assert values(spark, labels, dates.label_valid("a", False, 2019, 2023)) == [False, True, False, False, False, False, False, False]
    assert values(spark, labels, dates.label_valid("a", True, 2019, 2023)) == [False] * 6 + [True, False]


def test_segments(spark):
    proteins = ["RNA polymerase PB2", "alpha subunit", "Hemagglutinin", "HA protein", "NA x", None, "RNA polymerase"]
    assert values(spark, proteins, texts.segment_of_protein("a")) == ["PB2", None, "HA", "HA", "NA", None, None]
    assert values(spark, proteins, texts.segment_of_protein("a", whole_words=False))[1] == "HA"
    files = ["x_PA.fasta", "d/gisaid_H3N2.fa", "N1.fa", "nucleop.fa", "all.fasta", "PB1-x_HA.fa"]
    assert values(spark, files, texts.segment_of_file("a")) == ["PA", "HA", "NA", "NP", None, "PB1"]
    assert values(spark, files, texts.segment_of_file("a", strip_extension=False))[0] is None


def test_names(spark):
    assert values(spark, ["a b.c-1"], texts.safe_tag("a")) == ["a_b_c-1"]
    assert values(spark, ["d/x.y.fasta", ".hidden"], texts.file_stem("a")) == ["x.y", ".hidden"]
    assert values(spark, ["X.CSV", "y.csv.csv"], texts.benchmark_stem("a")) == ["X", "y.csv"]
    assert values(spark, ["3.9", "x", "", "-2"], texts.whole_number("a")) == [3, None, None, -2]
    row = spark.range(1).select(texts.annotation("orf", F.lit(1273), F.lit(0), F.lit(0.987)).alias("v")).first()
    assert row.v == "[orf_aa=1,273] [frame +1] [kmer_score=0.99]"
    assert len(spark.range(1).select(texts.job_name(F.lit("g"), F.lit("x" * 300)).alias("v")).first().v) == 200


@pytest.mark.parametrize("monthly", [True, False])
def test_axis_is_sorted(monthly):
    axis = dates.calendar(1999, 2003, monthly)
    assert axis == sorted(axis, key=dates.label_order) and len(set(axis)) == len(axis)
