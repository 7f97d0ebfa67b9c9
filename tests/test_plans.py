import json
import random

from pyspark.sql import functions as F

from tidemark.functions import sequences
from tidemark.operators import counts
from tidemark.plans import catalogue, grouping, pipeline, registry, routing, runs, schedule
from tidemark.sources import config, fasta, files, ordered, tables
from tidemark.streaming import incremental

import pytest


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_fasta_source(spark, tmp_path):
    body = "junk\n>a 1 x\r\nAC\r\ngt\r\n>b|2020-01\n\n>c\nA C\n" + "".join(f">r{i}\n{'ACGT' * (i % 7)}\n" for i in range(3000))
    (tmp_path / "x.fasta").write_text(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    got = fasta.read_fasta(spark, str(tmp_path / "x.fasta"))
    assert got.rdd.getNumPartitions() > 5
    seen = got.orderBy("ordinal").collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.rec_id, r.seq) for r in seen[:3]] == [("a", "ACGT"), ("b|2020-01", ""), ("c", "AC")]
    assert seen[0].description == "a 1 x" and [(r.rec_id, r.seq) for r in seen[3:]] == [(f"r{i}", "ACGT" * (i % 7)) for i in range(3000)]
    assert fasta.count_records(got).first().n_records == 3003
    assert [r.rec_id for r in fasta.first_records(got, 2).orderBy("ordinal").collect()] == ["a", "b|2020-01"]
    assert fasta.single_sequence(spark, str(tmp_path / "x.fasta")) == "ACGT"


def test_fasta_first_record_and_round_trip(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.fa").write_text(">one\nAC\n>two\nGT")
    (tmp_path / "d/b.FASTA").write_text(">three\nA\n")
    (tmp_path / "d/c.txt").write_text(">no\nA\n")
    got = fasta.read_fasta(spark, str(tmp_path), recursive=True)
    assert rows(got, "rec_id", "seq") == [("one", "AC"), ("three", "A"), ("two", "GT")]
    assert fasta.list_files(spark, str(tmp_path)).count() == 2
    fasta.write_fasta(got, str(tmp_path / "out"))
    again = fasta.read_fasta(spark, str(tmp_path / "out"))
    assert rows(again, "rec_id", "seq") == rows(got, "rec_id", "seq")


def test_fasta_writer(spark, tmp_path):
    """Lines of 60 letters, file order, empty and null sequences and headers."""
    made = spark.createDataFrame([(k, f"r{k}", "ACGTA" * (k % 31)) for k in range(500)] + [(500, None, None)], "k int, description string, seq string").repartition(7)
    fasta.write_fasta(made, str(tmp_path / "out"), order=("k",))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines()
    assert max(map(len, lines)) == 60 and [x for x in lines if x.startswith(">")] == [f">r{k}" for k in range(500)] + [">"]
    again = fasta.read_fasta(spark, str(tmp_path / "out"))
    assert sorted((r.description, r.seq) for r in again.collect()) == sorted((r.description or "", r.seq or "") for r in made.collect())


def test_many_files_in_few_partitions(spark, tmp_path):
    """Each file's first header loses its mark, text before it is no record, and headers that begin with > keep theirs."""
    want = []
    for k in range(20):
        body = f">f{k}|a\nAC\nGT\n>>odd{k}\nA\n>f{k}|b\n\n"
        (tmp_path / f"x {k}+1.{['fa', 'Fa', 'fasta', 'FAS'][k % 4]}").write_bytes((["", "junk\n", "\n", ">"][k % 4] + body).encode() + "é".encode("latin-1") * 0)
        want += [(f"x {k}+1", d, s) for d, s in ((f"f{k}|a" if k % 4 < 3 else f">f{k}|a", "ACGT"), (f">odd{k}", "A"), (f"f{k}|b", ""))]
    (tmp_path / "x 0+1.fa").write_bytes(b">f0|a\nAC\nGT\n>>odd0\nA\n>f0|b\n\n>caf\xe9 2020\nA\n")
    for size in ("134217728", "40"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = fasta.read_fasta(spark, str(tmp_path), recursive=True)
        seen = rows(got, "dataset", "description", "seq")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert seen == sorted([*want, ("x 0+1", "café 2020", "A")], key=repr)
    assert [r.n_records for r in fasta.count_records(got).collect()].count(3) == 19
    assert rows(fasta.datasets(spark, str(tmp_path), "x 3+1.FAS"), "dataset") == rows(fasta.datasets(spark, str(tmp_path), "x 3+1"), "dataset") == [("x 3+1",)]
    assert fasta.datasets(spark, str(tmp_path), "no").count() == 0 and fasta.datasets(spark, str(tmp_path)).count() == 20
    assert len(rows(fasta.first_records(got, 2), "description")) == 40


def test_config():
    c = config.parse(">protein_reference\nMK TA\n>motif_reference\nMK+TA\n>motif_reference_of protein\nTA\n".replace("of protein", "of_protein"))
    assert c.protein == "MKTA" and [(m.tag, m.parts, m.seq) for m in c.motifs] == [("motif1", ["MK", "TA"], "MKTA"), ("of_protein", ["TA"], "TA")]
    assert config.parse(config.render(c)) == c
    for bad in ("", ">protein\nMK1\n", ">protein\nMK\n>protein2\nMK\n", ">other\nMK\n", ">motif_reference\n+\n", ">motif_reference_a\nM\n>motif_reference_a\nK\n"):
        with pytest.raises(ValueError):
            config.parse(bad)
    assert config.parse_loosely(">protein_reference\nM-K.\n>motif_reference_x\nM+K\n") == ("MK", {"x": "M+K"})


REGISTRY = """benchmark_file,dms_id,virus_code,host,target_seq,target_type,recommended_reference,seq_len,protein,uniprot_full_len,full_protein_seq
a.csv,a,IAV,human,MKTA,x,target_as_reference,4,hemagglutinin,10,
b.csv,b,IAV,human,MK-TA,x,,5,hemagglutinin,,
c.csv,c,IAV,avian,TA,x,full_protein_plus_motif,9,PB2,4.0,MKTA
d.csv,d,SCV2,human,,x,target_as_reference,,,,
e.csv,e,SCV2,human,M1,x,odd,,,,
"""


@pytest.fixture
def registered(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿" + REGISTRY)
    return tables.read_registry(spark, str(tmp_path / "r.csv"))


def test_registry(spark, registered, tmp_path):
    assert tables.missing_columns(registered) == []
    assert rows(registry.violations(registered), "benchmark_file", "rule") == [
        ("b.csv", "empty recommended_reference"), ("c.csv", "seq_len"), ("d.csv", "empty target_seq"), ("e.csv", "letters of target_seq"), ("e.csv", "recommended_reference")]
    for name in ("a.csv", "z.csv", "r.csv"):
        (tmp_path / name).write_text(REGISTRY if name == "r.csv" else "x\n")
    disk = tables.list_benchmarks(spark, str(tmp_path), "r.csv")
    assert rows(registry.compare(disk, registered), "benchmark_file", "status") == [("a.csv", "ok"), ("b.csv", "missing"), ("c.csv", "missing"), ("d.csv", "missing"), ("e.csv", "missing"), ("z.csv", "new")]


def test_grouping(registered):
    found = {r.group_id: r for r in grouping.groups(grouping.usable(registered)).collect()}
    ref = next(r for r in found.values() if r.reference == "MKTA")
    assert ref.benchmarks == ["a.csv", "b.csv", "c.csv"] and ref.binning == "yearly" and ref.segment == "HA" and ref.parent_len == 10
    assert [(m.tag, m.len, m.benchmarks) for m in ref.motifs] == [("whole", 4, ["a.csv", "b.csv"]), ("c", 2, ["c.csv"])]
    assert ref.group_id.startswith("IAV_4aa_")
    assert rows(grouping.usable(registered).where("blocked is not null"), "benchmark_file", "blocked") == [("d.csv", "empty target")]


def test_routing(spark):
    one = spark.range(1)
    tiers = lambda v, h, s: one.select(routing.folder_tiers(F.lit(v), F.lit(h), F.lit(s).cast("string")).alias("x")).first().x
    assert tiers("IAV", "Human", "HA") == ["IAV/human/HA", "IAV/all/HA", "IAV/human", "IAV/all", "IAV"]
    assert tiers("IAV", "swine", "HA") == ["IAV/all/HA", "IAV/all", "IAV"] and tiers("SCV2", "x", None) == ["SCV2"] and tiers(" HIV ", None, None) == ["HIV"]

    def mode(mol, state, med, ref, parent):
        x = spark.createDataFrame([(mol, state, med, ref, parent)], "m string, s string, d double, r int, p int")
        return x.select(routing.suitability(F.col("m"), F.col("s"), F.col("d"), F.col("r"), F.col("p")).alias("v")).first().v

    assert mode("protein", "aligned", 90.0, 100, None) == "protein_aligned" and mode("protein", "raw", 50.0, 100, None) is None
    assert mode("nucleotide", "raw", 8000.0, 9, None) == "genome" and mode("nucleotide", "raw", 450.0, 100, None) == "cds"
    assert mode("nucleotide", "aligned", 1200.0, 100, 400) == "subregion_aligned" and mode("nucleotide", "raw", 1200.0, 100, 110) is None
    assert mode("other", "raw", 1.0, 1, 1) is None


def test_route_and_status(spark, registered, tmp_path):
    groups = grouping.groups(grouping.usable(registered))
    files = [{"path": f"/x/{f}/{n}", "rel_path": n, "folder": f, "molecule": "nucleotide", "state": "raw", "median_length": 12, "n_records": 5, "size_bytes": 9} for f, n in (("IAV/human", "u_PB2.fa"), ("IAV/human", "v.fa"), ("IAV/all", "w.fa"))]
    (tmp_path / "inv.json").write_text(json.dumps({"fasta_root": "/x", "scanned_at": "", "sample_size": 1, "files": files}))
    routed = routing.route(groups, tables.read_inventory(spark, str(tmp_path / "inv.json")))
    assert rows(routed, "path", "tier", "mode", "reason") == [("/x/IAV/human/u_PB2.fa", "IAV/human", None, "other segment"), ("/x/IAV/human/v.fa", "IAV/human", "cds", None)]
    assert rows(routing.plan_status(groups, routed), "status") == [("no folder",), ("planned",)]


def test_ratio_join_matches_brute_force(spark):
    a = [1, 2, 3, 5, 8, 13, 60, 61, 100, 0]
    b = [1, 2, 4, 50, 100, 150]
    got = routing.lengths_within(spark.createDataFrame([(x,) for x in a], "x int"), spark.createDataFrame([(x,) for x in b], "y int"), "x", "y")
    assert rows(got, "x", "y") == sorted(((x, y) for x in a for y in b if x > 0 and 0.6 <= x / y <= 1.5), key=repr)


def test_waves_and_resume(spark):
    g = spark.createDataFrame([("c", 1), ("a", 3), ("b", 1), ("d", 2), ("e", 1)], "group_id string, files int")
    assert rows(schedule.waves(g, 2), "group_id", "wave") == [("a", 0), ("b", 2), ("c", 2), ("d", 1), ("e", 3)]
    assert rows(schedule.unfinished(g, g.where("files > 1"), ["group_id"]), "group_id") == [("b",), ("c",), ("e",)]
    assert rows(schedule.only(g, "a"), "group_id") == [("a",)]


FASTA = ">s1|2020-01-02\nATGAAAACAGCA\n>s2|2020-02\nATGAAAACAGCA\n>s3/2019\nATGAAAACAGAA\n>s4\nATGAAA\n"


def test_engine_branches(spark, tmp_path):
    path = tmp_path / "d.fasta"
    path.write_text(FASTA)
    raw = pipeline.run(spark, str(path), config.parse(">protein_reference\nMKTA\n>motif_reference_m\nKT\n"))
    assert rows(raw, "motif_tag", "nt", "aa", "year", "month", "n") == [("m", "AAAACA", "KT", 2019, None, 1), ("m", "AAAACA", "KT", 2020, 1, 1), ("m", "AAAACA", "KT", 2020, 2, 1)]
    whole = pipeline.run(spark, str(path), config.parse(">protein\nMKTA\n"))
    assert rows(whole.where("year = 2019"), "motif_tag", "nt", "aa") == [("whole", "ATGAAAACAGAA", "MKTE")]
    with pytest.raises(ValueError):
        pipeline.run(spark, str(path), config.parse(">motif_reference\nKT\n"))
    path.write_text(">a|2020-01\nATGAAAACAGCA\n>b|2020-01\nATGAAAACAG--\n")
    aligned = pipeline.run(spark, str(path), config.parse(">motif_reference\nMK\n"))
    assert rows(aligned, "motif_tag", "nt", "aa", "n") == [("motif", "ATGAAA", "MK", 2)]
    counted = pipeline.run(spark, str(path), config.parse(">protein_reference\nMKTA\n"))
    assert rows(counted, "nt", "aa") == [("ATGAAAACAG", "MKT"), ("ATGAAAACAGCA", "MKTA")]
    path.write_text(">a|2020-01\nMKTAF\n>b|2020-01\nMKT-F\n")
    peptides = pipeline.run(spark, str(path), config.parse(">motif_reference\nKT\n"))
    assert rows(peptides, "nt", "aa", "n") == [("", "KT", 2)]


def test_sinks(spark, tmp_path):
    long = spark.createDataFrame([("g", "m", "AAA", "K", 2020, 1, 3), ("g", "o", "", "P", None, None, 1)], "group_id string, motif_tag string, nt string, aa string, year int, month int, n long")
    tables.write_counts(long, str(tmp_path / "long"))
    assert rows(tables.read_counts(spark, str(tmp_path / "long"), "g", "m"), "nt", "n") == [("AAA", 3)]
    wide = counts.rename_keys(counts.most_counted(counts.wide_counts(long, start=2020)))
    files.write_csv(wide, str(tmp_path / "wide.csv"))
    back = tables.read_wide_counts(spark, str(tmp_path / "wide.csv"))
    keys = [tables.NT, tables.AA]
    assert rows(counts.from_wide(back, keys), *keys, "bin", "n") == [("", "P", "unknown", 1), ("AAA", "K", "2020", 3)]


@pytest.mark.parametrize("whole", [1000, 40])
def test_many_ordered_tables(spark, tmp_path, whole, request):
    """Tables with other columns each, written in one job: in order, a table beyond the bound as numbered parts whose lines are the table; a second run puts all in place again."""
    rng = random.Random(5)
    rows = [("big", f"A{k:03}", 'K,"' if k == 7 else "K", str(2000 + y), rng.randrange(1, 9)) for k in range(300) for y in range(3)] + [("small", "", "P", "unknown", 2), ("small", "A", "", "2001", 2)]
    long = spark.createDataFrame(rows, "table string, nt string, aa string, bin string, n long")
    made = {"big": ordered.Table(["2000", "2001", "2002"], ["x.csv", "y z.csv"]), "small": ordered.Table(["2001", "unknown"], ["s_counts_by_year_wide.csv"], total=False), "none": ordered.Table(["unknown"], ["n.csv"])}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    for _ in range(2):
        assert len(ordered.write_wide(long, made, str(tmp_path), whole)) == 4
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["n.csv", "s_counts_by_year_wide.csv", "x.csv", "y z.csv"]
        text = {p.name: "".join(q.read_text() for q in (sorted(p.glob("part-*")) if p.is_dir() else [p])) for p in tmp_path.iterdir() if not p.name.startswith(".")}
        counted = {k: [n for t, nt, _, _, n in rows if t == "big" and nt == k] for k in {r[1] for r in rows if r[0] == "big"}}
        expected = sorted(counted, key=lambda k: (-sum(counted[k]), k))
        lines = [f"{k},{chr(34) + 'K,' + chr(92) + chr(34) + chr(34) if k == 'A007' else 'K'},{','.join(map(str, counted[k]))},{sum(counted[k])}" for k in expected]
        assert text["x.csv"].splitlines() == text["y z.csv"].splitlines() == ["Motif Nucleotide,Motif Peptide,2000,2001,2002,Count", *lines]
        assert text["s_counts_by_year_wide.csv"].splitlines() == ["Motif Nucleotide,Motif Peptide,2001,unknown", ",P,0,2", "A,,2,0"]
        assert text["n.csv"].splitlines() == ["Motif Nucleotide,Motif Peptide,unknown,Count"]
        assert (tmp_path / "x.csv").is_dir() == (whole < 300) and (tmp_path / "s_counts_by_year_wide.csv").is_file()
    if whole < 300:
        (tmp_path / "x.csv").rename(tmp_path / "x_counts_by_year_wide.csv")
        back = tables.read_wide_tables(spark, [str(tmp_path / "x_counts_by_year_wide.csv")]).where("nt <> 'A007'")
        assert sorted((r.nt, r.bin, r.n) for r in back.collect()) == sorted((nt, y, n) for t, nt, _, y, n in rows if t == "big" and nt != "A007")


def test_stream_adds_up(spark, tmp_path):
    data = spark.createDataFrame([("AAA", "K", 2020, 1)] * 5 + [("CCC", "P", None, None)] * 2, "nt string, aa string, year int, month int")
    for k in range(3):
        data.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        incremental.count_stream(stream, lambda b: b, str(tmp_path / "counts"), str(tmp_path / "state")).awaitTermination()
        got = incremental.read_stream_counts(spark, str(tmp_path / "counts"))
        assert rows(got, "nt", "n") == [("AAA", 5 * (k + 1)), ("CCC", 2 * (k + 1))]


def test_catalogue(spark):
    a = spark.createDataFrame([("g", "h", 4, "c")], "group_id string, ref_hash string, ref_len int, config string")
    c = spark.createDataFrame([("g", "x", True, True, {"m": "p"}), ("g", "y", True, False, {})], "group_id string, chunk string, msa_complete boolean, aligned_proteins boolean, counts_by_motif map<string,string>")
    chunks = schedule.catalogue(a, c).first().chunks
    assert chunks["x"].reusable and not chunks["y"].reusable and sequences.KMER == 10


CDS = "ATGAAAACAGCATATATTGCAAAACAACGT"


def test_command_line_from_registry_to_training_tables(spark, tmp_path, monkeypatch, capsys):
    """check, scan, aligned, plan, tasks and aggregate in a folder; a second run has nothing to do."""
    from tidemark import cli

    monkeypatch.chdir(tmp_path)
    top = str(tmp_path)
    at = lambda *names: [f"{top}/{n}" for n in names]
    (tmp_path / "bench").mkdir()
    header = "benchmark_file,dms_id,virus_code,host,target_seq,target_type,recommended_reference,seq_len,protein,uniprot_full_len,full_protein_seq\n"
    good = header + "a.csv,a,HIV,human,MKTAYIAKQR,x,target_as_reference,10,,,\nb.csv,b,HIV,human,TAYI,x,full_protein_plus_motif,4,,,MKTAYIAKQR\nc.csv,c,SCV2,human,MKTA,x,target_as_reference,4,,,\n"
    (tmp_path / "bench/r.csv").write_text(good)
    for n in "abc":
        (tmp_path / f"bench/{n}.csv").write_text("x\n")
    (tmp_path / "raw/HIV").mkdir(parents=True)
    (tmp_path / "raw/HIV/one.fasta").write_text("".join(f">s{i}|{2000 + i % 3}-01\n{CDS}\n" for i in range(9)))
    (tmp_path / "raw/HIV/two.fa").write_text("".join(f">s{i}\n{CDS[:12]}TGG{CDS[15:]}\n" for i in range(4)))
    bench = ["--benchmark-dir", f"{top}/bench", "--registry", f"{top}/bench/r.csv"]
    raw, inv, plan, aligned, train = at("raw", "inv.json", "plan.json", "aligned", "train")
    assert cli.main(["check", *bench], spark) == 0
    assert cli.main(["scan", "--fasta-root", raw, "--out", inv], spark) == 0
    assert cli.main(["scan", "--fasta-root", f"{top}/bench", "--out", inv], spark) == 1
    assert cli.main(["plan", "--inventory", inv, "--out", plan, "--config-dir", f"{top}/configs", *bench], spark) == 0
    doc = json.loads((tmp_path / "plan.json").read_text())
    (group,) = doc["groups"]
    assert [s["benchmark_file"] for s in doc["skipped"]] == ["c.csv"] and {m["tag"] for m in group["motifs"]} == {"whole", "b"} and len(group["fasta_files"]) == 2
    tasks = ["tasks", "--plan", plan, "--aligned-root", aligned]
    assert cli.main([*tasks, "--dry-run"], spark) == 0 and not (tmp_path / "aligned").exists()
    assert cli.main(tasks, spark) == 0
    assert cli.main(["aligned", "--aligned-root", aligned, "--out", f"{top}/cat.json"], spark) == 0
    (found,) = json.loads((tmp_path / "cat.json").read_text())["groups"].values()
    named = {k[:-9]: v for k, v in found["chunks"].items()}
    assert named["one"]["reusable"] and set(named["two"]["counts_by_motif"]) == {"whole", "b"}
    assert cli.todo(spark, cli.parser().parse_args(tasks))[1].count() == 0
    assert cli.main(["aggregate", "--plan", plan, "--aligned-root", aligned, "--out-dir", train], spark) == 0
    assert (tmp_path / "train/b_training_counts.csv").read_text().splitlines() == ["Motif Nucleotide,Motif Peptide,2000,2001,2002,unknown", "ACAGCATATATT,TAYI,3,3,3,0", "ACAGCATGGATT,TAWI,0,0,0,4"]
    summary = (tmp_path / "train/_aggregation_summary.csv").read_text()
    assert summary.count(",OK") == 2 and ",2,2,0,13,0,4,2000..2002," in summary
    assert cli.main(["aligned", "--register", f"{aligned}/{group['group_id']}", "--config", f"{top}/configs/{group['group_id']}.txt", *bench], spark) == 0
    assert f"{group['group_id']} is" in capsys.readouterr().out.replace(f"{aligned}/", "")
    (tmp_path / "bench/r.csv").write_text(good.replace("MKTA,x", "MKBA,x"))
    assert cli.main(["check", *bench], spark) == 1
    (tmp_path / "bench/r.csv").write_text(good.replace("MKTA,x,target_as_reference,4", "MKTA,x,target_as_reference,5"))
    assert cli.main(["check", *bench], spark) == 0  # a wrong seq_len is a warning


def test_all_steps(spark, tmp_path, monkeypatch):
    """A dry run leaves nothing; files of one name in two folders are two chunks; an open chunk doesn't keep the others from being aggregated."""
    from tidemark import cli

    monkeypatch.setattr(cli, "COMMANDS", dict(cli.COMMANDS))
    parse = cli.parser().parse_args
    at = {k: f"{tmp_path}/{k}" for k in ("benchmark_dir", "fasta_root", "aligned_root", "config_dir", "out_dir")} | {"registry": f"{tmp_path}/benchmark_dir/r.csv"}
    own = {"inventory": f"{tmp_path}/inv.json", "plan": f"{tmp_path}/plan.json"}
    outs = {"scan": own["inventory"], "aligned": f"{tmp_path}/cat.json", "plan": own["plan"]}

    def placed(args):
        a = parse(args)
        for k, v in {**at, **own, **({"out": outs[a.command]} if a.command in outs else {})}.items():
            if hasattr(a, k) and f"--{k.replace('_', '-')}" not in args:
                setattr(a, k, v)
        return a

    monkeypatch.setattr(cli, "parser", lambda: type("P", (), {"parse_args": staticmethod(placed)}))
    (tmp_path / "benchmark_dir").mkdir()
    (tmp_path / "benchmark_dir/r.csv").write_text("benchmark_file,dms_id,virus_code,host,target_seq,target_type,recommended_reference\na.csv,a,HIV,human,MKTAYIAKQR,x,target_as_reference\n")
    (tmp_path / "benchmark_dir/a.csv").write_text("x\n")
    for folder, n in (("HIV/x", 3), ("HIV/y", 2)):
        (tmp_path / "fasta_root" / folder).mkdir(parents=True)
        (tmp_path / "fasta_root" / folder / "one.fasta").write_text("".join(f">s{i}|2001-01\n{CDS}\n" for i in range(n)))
    before = sorted(tmp_path.rglob("*"))
    assert cli.main(["all", "--dry-run"], spark) == 0 and sorted(tmp_path.rglob("*")) == before
    (tmp_path / "fasta_root/HIV/bad.fasta").write_text(">s|2001\n" + "TAA" * 10 + "\n")
    assert cli.main(["all"], spark) == 1
    assert (tmp_path / "out_dir/a_training_counts.csv").read_text().splitlines() == ["Motif Nucleotide,Motif Peptide,2001,unknown", f"{CDS},MKTAYIAKQR,5,0"]


def test_wide_tables_in_one_scan(spark, tmp_path):
    """Many tables with columns of their own; written here and elsewhere, as files and as folders."""
    for k in range(40):
        (tmp_path / f"t{k}").mkdir()
        (tmp_path / f"t{k}/x_counts_by_year_wide.csv").write_text(f"\ufeffMotif Nucleotide,Motif Peptide,{2000 + k % 3},unknown,Count\r\nAAA,K,{k},1.0,9\r\n,P,x,0,1\r\n")
    spark.createDataFrame([("", "K", 5)], ["Motif Nucleotide", "Motif Peptide", "1999"]).write.option("header", "true").csv(str(tmp_path / "d/x_counts_by_year_wide.csv"))
    paths = [f"{tmp_path}/t{k}/x_counts_by_year_wide.csv" for k in range(40)] + [f"{tmp_path}/d/x_counts_by_year_wide.csv"]
    got = tables.read_wide_tables(spark, paths)
    assert rows(got.groupBy("nt", "aa", "bin").agg(F.sum("n").alias("n")), "nt", "aa", "bin", "n") == [
        ("", "K", "1999", 5), ("AAA", "K", "2000", sum(range(0, 40, 3))), ("AAA", "K", "2001", sum(range(1, 40, 3))), ("AAA", "K", "2002", sum(range(2, 40, 3))), ("AAA", "K", "unknown", 40)]
    assert got.select("path").distinct().count() == 41


def test_run_of_a_folder(spark, tmp_path):
    """Every dataset by its own configuration; a failing one doesn't stop the others; single datasets add to the integrated table."""
    from tidemark import cli
    from tidemark.plans import runs

    top, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.fasta").write_text(">a|2020-01-02\nATGAAAACAGCA\n>b|2020-02\nATGAAAACAGCA\n>c\nTA\n")
    (tmp_path / "in/y.fa").write_text(">a|2021\nATGAAAACAGCA\n")
    (tmp_path / "in/z.fa").write_text("")
    (tmp_path / "in/reference.txt").write_text(">protein_reference\nMKTA\n>motif_reference_k\nKT\n>motif_reference_t\nTA\n")
    got = {r.dataset: r for r in runs.run(spark, top, out).collect()}
    assert [got[d].status for d in "xyz"] == ["OK", "OK", "FAILED"] and got["z"].error == "no sequences"
    assert (got["x"].input_sequences, got["x"].cds_kept, got["x"].cds_dropped_short, got["x"].counted_records, got["TOTAL"].cds_in) == (3, 2, 1, 4, 4)
    assert got["x"].motif_detail == "k: kept 2; k: 1 variants; t: kept 2; t: 1 variants"
    assert (tmp_path / "out/x/x_k_counts_by_year_wide.csv").is_file() and (tmp_path / "out/run_summary.csv").read_text().startswith(",".join(runs.SUMMARY))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out/x/x_aligned_nucleotides.fasta").glob("part-*")))
    assert text == ">a|2020-01-02 [cds_aa=4] [frame +1]\nATGAAAACAGCA\n>b|2020-02 [cds_aa=4] [frame +1]\nATGAAAACAGCA\n"
    assert "".join(p.read_text() for p in sorted((tmp_path / "out/x/x_t_motif_proteins.fasta").glob("part-*"))).splitlines()[1::2] == ["TA", "TA"]
    table = (tmp_path / "out/integrated_k_counts_by_year_wide.csv").read_text().splitlines()
    assert table == ["Motif Nucleotide,Motif Peptide,before 2020,2020,2021,unknown,Count", "AAAACA,KT,0,2,1,0,3"]
    assert cli.main(["run", "--input-dir", top, "--output-dir", out, "--dataset", "y", "--monthly"], spark) == 0 and (tmp_path / "out/y/.msa_complete").is_file()
    assert "2020-01" in (tmp_path / "out/integrated_k_counts_by_month_wide.csv").read_text()
    assert cli.main(["run", "--input-dir", top, "--output-dir", out, "--dataset", "nope"], spark) == 1
    assert runs.names("d", ["motif"], True) == [("motif", "", "d_motif", "d_counts_by_month_wide.csv")] and runs.names("d", [], False)[0][3] == "d_counts_by_year_wide.csv"


def test_integration_reads_what_changed(spark, tmp_path, monkeypatch):
    """Unchanged datasets aren't read, a stopped run is made good, motifs and datasets that are gone leave the sums."""
    from tidemark.plans import integration, runs
    from tidemark.sources import files

    top = str(tmp_path)

    def give(dataset, *found):
        spark.createDataFrame([(i, i[1:], "K", y, None, n) for i, y, n in found], integration.COUNTED).write.mode("overwrite").parquet(f"{top}/{dataset}/{integration.STORE}/count=x")

    def held():
        return sorted(((r.infix, r.year, r.n) for r in integration.sums(spark, top).collect()), key=str)

    assert integration.update(spark, top) == [] and held() == []
    give("a", ("_p", 2020, 3), ("_q", None, 1))
    give("b", ("_p", 2020, 2))
    assert len(runs.integrate(spark, top, runs.Options())) == 2 and held() == [("_p", 2020, 5), ("_q", None, 1)]
    assert runs.integrate(spark, top, runs.Options()) == []
    for p in (tmp_path / "a").rglob("*.parquet"):
        p.write_bytes(bytes(p.stat().st_size))  # whoever reads it fails
    for p in (tmp_path / "a").rglob(".*.crc"):
        p.unlink()
    give("b", ("_p", 2021, 7))
    give("c", ("_r", 2020, 1))
    real = files.write_text
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        integration.update(spark, top, {"monthly": False, "start_year": None})
    monkeypatch.setattr(files, "write_text", real)
    assert held() == [("_p", 2020, 5), ("_q", None, 1)]
    assert integration.update(spark, top, {"monthly": False, "start_year": None}) == ["_p", "_r"]
    assert held() == [("_p", 2020, 3), ("_p", 2021, 7), ("_q", None, 1), ("_r", 2020, 1)]
    made = runs.integrate(spark, top, runs.Options())  # tables of the update whose run ended before them
    assert [p.rsplit("/", 1)[-1] for p in made] == ["integrated_p_counts_by_year_wide.csv", "integrated_r_counts_by_year_wide.csv"]
    assert (tmp_path / "integrated_p_counts_by_year_wide.csv").read_text().splitlines()[1] == "p,K,0,3,7,0,10"
    files.delete(spark, f"{top}/c")
    assert runs.integrate(spark, top, runs.Options()) == [] and not (tmp_path / "integrated_r_counts_by_year_wide.csv").exists()
    assert len(list((tmp_path / "_integration").glob("sums-*"))) == 1 and len(list((tmp_path / "_integration/parts").iterdir())) == 2


def test_stream_of_files(spark, tmp_path):
    """Each file is counted once; a batch that is run again after it was compacted doesn't count twice; a compaction that is stopped changes nothing."""
    from tidemark.plans import pipeline
    from tidemark.sources import files

    inbox, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    (tmp_path / "in/deep").mkdir(parents=True)

    def to_fragments(records):
        return pipeline.dated(records).select(F.col("seq").alias("nt"), F.lit("").alias("aa"), "year", "month")

    def count(**k):
        return rows(incremental.count_folder(spark, inbox, to_fragments, out, state, **k), "nt", "year", "n")

    def give(name, *records):
        (tmp_path / "made.tmp").write_text("".join(f">r|{y}-01\n{s}\n" for s, y in records))
        (tmp_path / "made.tmp").rename(tmp_path / "in" / name)

    assert count() == []
    give("a.fa", ("AC", 2020), ("AC", 2020), ("GT", 2021))
    give("notes.txt", ("AC", 2020))
    assert count() == [("AC", 2020, 2), ("GT", 2021, 1)] == count()
    give("deep/a.FASTA", ("AC", 2020))
    assert count(beyond=0) == [("AC", 2020, 3), ("GT", 2021, 1)] and not list((tmp_path / "out").glob("batch=*"))
    give("b.fa", ("T", 2020))
    assert count(beyond=0) == [("AC", 2020, 3), ("GT", 2021, 1), ("T", 2020, 1)]
    last = max((tmp_path / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    assert count(beyond=9) == [("AC", 2020, 3), ("GT", 2021, 1), ("T", 2020, 1)]  # the last batch was run again
    give("c.fa", ("T", 2020))
    assert count(beyond=9)[-1] == ("T", 2020, 2) and len(list((tmp_path / "out").glob("batch=*"))) == 1
    real = files._replace
    files._replace = lambda *a: (_ for _ in ()).throw(OSError("stopped"))
    try:
        with pytest.raises(OSError):
            incremental.compact(spark, out)
    finally:
        files._replace = real
    assert rows(incremental.read_stream_counts(spark, out), "nt", "n") == [("AC", 3), ("GT", 1), ("T", 2)]
    assert incremental.compact(spark, out) and not incremental.compact(spark, out)
    assert rows(incremental.read_stream_counts(spark, out), "nt", "n") == [("AC", 3), ("GT", 1), ("T", 2)]


def test_a_stopped_run_leaves_the_former_folder(spark, tmp_path, monkeypatch):
    """A dataset's folder is replaced whole: a failing or stopped run, at any step, leaves the former one readable, and the next run clears what was left."""
    c, o, out = config.parse(">motif_reference\nMK\n"), runs.Options(start_year=2019), str(tmp_path / "g/x")
    source, broken = tmp_path / "x.fa", tmp_path / "y.fa"
    source.write_text(">a|2020-01\nATGAAAACAGCA\n>b|2020-01\nATGAAAACAG--\n")
    broken.write_text(">a|2020-01\n---AAAACAGCA\n>b|2020-01\n---AAAACAG--\n")

    def held():
        files.recover(spark, out)
        listed = {p for p, _ in files.walk(spark, out) if "/." not in p and not p.startswith(".")}
        return listed, [r.path for r in catalogue.listing(spark, str(tmp_path)).where("path like 'g/%csv'").collect()]

    first = runs.process(spark, str(source), "x", c, out, o)
    assert first[0]["counted_records"] == 2 and rows(first[1], "nt", "aa", "n") == [("ATGAAA", "MK", 2)] and [p.name for p in (tmp_path / "g").iterdir()] == ["x"]
    before = held()
    with pytest.raises(ValueError):
        runs.process(spark, str(broken), "x", c, out, o)
    assert held() == before and [p.name for p in (tmp_path / "g").iterdir()] == ["x"]
    stop = lambda *a: (_ for _ in ()).throw(OSError("stopped"))
    for step in ("publish", "discard"):
        with monkeypatch.context() as m:
            m.setattr(files, "publish", stop)
            if step == "discard":
                m.setattr(files, "discard", stop)
            with pytest.raises(OSError):
                runs.process(spark, str(source), "x", c, out, o)
        assert held() == before
    assert list((tmp_path / "g/_making").iterdir())
    (tmp_path / "g/_former").mkdir()
    (tmp_path / "g/x").rename(tmp_path / "g/_former/x")  # stopped between the two steps
    assert held() == before and not (tmp_path / "g/_former").exists()
    runs.process(spark, str(source), "x", c, out, o)
    after = held()
    assert after[0] != before[0] and after[1] == before[1] and [p.name for p in (tmp_path / "g").iterdir()] == ["x"]
