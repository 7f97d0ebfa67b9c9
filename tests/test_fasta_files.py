"""Tables written as FASTA files, in order."""

import functools

import pytest
from pyspark.sql import functions as F

from tidemark.plans import inventory, runs
from tidemark.queries_files import as_files
from tidemark.sources import fasta, ordered, tables


def records(spark, n=4000, files=3):
    """Records of some files, dealt over eight partitions without their order."""
    d = spark.range(0, n, 1, 8).withColumn("k", (F.col("id") * 7919) % n)
    return d.select(F.concat(F.lit("d/s"), F.col("k") % files, F.lit(".fasta")).alias("path"), F.col("k").alias("place"), F.concat(F.lit("r"), "k").alias("description"), F.lit("ACGT").alias("seq"))


def test_records_of_a_file_are_in_order(spark, tmp_path):
    top = as_files(records(spark), str(tmp_path / "in"))
    for k in range(3):
        heads = [int(line[2:]) for line in open(f"{top}/d/s{k}.fasta") if line.startswith(">")]
        assert heads == list(range(k, 4000, 3))


def test_a_large_file_is_written_in_parts_and_is_one_file(spark, tmp_path):
    """Of a file of more bytes than a part's no task holds all; listed, counted, scanned and run it is one file, its records in order."""
    own = records(spark, files=1).withColumn("seq", F.when(F.col("place") == 0, "TTTT").otherwise(F.col("seq")))
    small = records(spark, 30).withColumn("path", F.concat(F.lit("e/"), F.substring("path", 3, 9)))
    top = as_files(own.unionByName(small), str(tmp_path / "in"), 10_000)
    parts = sorted(p.name for p in (tmp_path / "in/d/s0.fasta").iterdir() if not p.name.startswith("."))
    assert len(parts) >= 4 and parts[0] == "part-00000.fasta" and max((tmp_path / "in/d/s0.fasta" / p).stat().st_size for p in parts) < 20_000
    assert (tmp_path / "in/e/s0.fasta").is_file()
    got = fasta.read_fasta(spark, top, recursive=True)
    assert [int(r.rec_id[1:]) for r in got.where("file_path like '%/d/%'").orderBy("file_path", "ordinal").collect()] == list(range(4000))
    assert {r.dataset for r in got.select("dataset").distinct().collect()} == {"s0", "s1", "s2"}
    assert fasta.list_files(spark, top).count() == 4 and fasta.list_files(spark, f"{top}/d", False).count() == 1
    assert {r.file_path.removeprefix(top): r.n_records for r in fasta.count_records(got).collect()} == {"/d/s0.fasta": 4000, "/e/s0.fasta": 10, "/e/s1.fasta": 10, "/e/s2.fasta": 10}
    assert [(r.dataset, r.path) for r in fasta.datasets(spark, f"{top}/d").collect()] == [("s0", f"{top}/d/s0.fasta")]
    assert fasta.single_sequence(spark, f"{top}/d/s0.fasta") == "TTTT"
    row = inventory.scan(spark, top, 1).where("folder = 'd'").first()
    assert (row.rel_path, row.n_records, row.median_length) == ("d/s0.fasta", 4000, 4) and row.size_bytes == sum((tmp_path / "in/d/s0.fasta" / p).stat().st_size for p in parts)


def test_a_run_takes_a_file_in_parts_as_one_dataset(spark, tmp_path):
    rows = records(spark, 200, 1).select(F.lit("a.fasta").alias("path"), "place", "description", F.when(F.col("place") % 2 == 0, "MKTAY").otherwise("MKTA-").alias("seq"))
    top = as_files(rows, str(tmp_path / "in"), 500)
    assert (tmp_path / "in/a.fasta").is_dir()
    table = runs.run(spark, top, str(tmp_path / "out"), config_text=">motif_reference_m\nMKT\n")
    assert [(r.dataset, r.status, r.input_sequences, r.counted_records) for r in table.collect()][0] == ("a", "OK", 200, 200)


def test_a_run_deals_the_records_of_one_gene(spark, tmp_path):
    """A run's records that all have one peptide are joined to its alignment in many tasks, though the join is by peptide."""
    gene = "ATGAAAACTGCTTATATTGCTAAACAA"
    rows = records(spark, 1000, 1).select(F.lit("a.fasta").alias("path"), "place", "description", F.lit(gene).alias("seq"))
    top = as_files(rows, str(tmp_path / "in"))
    given = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
            spark.conf.set(k, v)
        table = runs.run(spark, top, str(tmp_path / "out"), config_text=">protein_reference\nMKTAYIAKQ\n>motif_reference_m\nTAY\n")
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)
    row = table.where("dataset = 'a'").first()
    assert (row.status, row.input_sequences, row.aligned, row.motif_kept, row.counted_records, row.unique_variants) == ("OK", 1000, 1000, 1000, 1000, 1)
    each = [r["count"] for r in spark.read.parquet(str(tmp_path / "out/a/aligned")).groupBy(F.input_file_name()).count().collect()]
    assert len(each) > 1 and max(each) < 700


def test_a_large_file_of_few_long_records_is_written_in_parts_beside_one_of_many_short_ones(spark, tmp_path):
    """A file's parts are of like size, though another large file has most of the records."""
    short = records(spark, 3000, 1).select(F.lit("b.fasta").alias("path"), "place", "description", "seq")
    long = records(spark, 20, 1).select(F.lit("c.fasta").alias("path"), "place", "description", F.repeat(F.lit("ACGTA"), 1000).alias("seq"))
    top = as_files(short.unionByName(long), str(tmp_path / "in"), 10_000)
    for name, n in (("b", 3000), ("c", 20)):
        parts = [p.stat().st_size for p in (tmp_path / f"in/{name}.fasta").iterdir() if not p.name.startswith(".")]
        assert len(parts) >= 3 and max(parts) < 30_000
        got = fasta.read_fasta(spark, f"{top}/{name}.fasta").orderBy("file_path", "ordinal").collect()
        assert [int(r.rec_id[1:]) for r in got] == list(range(n))


@pytest.mark.parametrize("bound", [{"whole": 100}, {"most": 2000}])
def test_a_large_count_table_of_a_run_is_made_by_many_tasks(spark, tmp_path, monkeypatch, request, bound):
    """A dataset's count table beyond a bound, of rows or of bytes, is a folder of parts whose lines are the table, and is read back whole."""
    monkeypatch.setattr(ordered, "write_wide", functools.partial(ordered.write_wide, **bound))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    seq = F.concat(F.lit("MEF"), F.translate(F.lpad(F.expr("place div 2").cast("string"), 4, "0"), "0123456789", "ACDEFGHIKL"), F.lit("-"))
    rows = records(spark, 601, 1).select(F.lit("a.fasta").alias("path"), "place", F.lit("r|2020-01").alias("description"), seq.alias("seq"))
    runs.run(spark, as_files(rows, str(tmp_path / "in")), str(tmp_path / "out"), runs.Options(start_year=2019), config_text=">protein_reference\nMEF\n")
    made = tmp_path / "out/a/a_counts_by_year_wide.csv"
    parts = sorted(p for p in made.iterdir() if p.name.startswith("part-"))
    assert len(parts) > 1 and max(p.stat().st_size for p in parts) < 6000
    lines = "".join(p.read_text() for p in parts).splitlines()
    peptides = ["MEF" + f"{k:04}".translate(str.maketrans("0123456789", "ACDEFGHIKL")) + "-" for k in range(301)]
    assert lines == ["Motif Nucleotide,Motif Peptide,before 2019,2019,2020,unknown,Count", *(f",{p},0,0,2,0,2" for p in peptides[:300]), f",{peptides[300]},0,0,1,0,1"]
    back = tables.read_wide_counts(spark, str(made))
    assert back.count() == 301 and back.columns == lines[0].split(",")
