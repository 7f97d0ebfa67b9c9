import json
import logging
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from jobs import queries, training_tables, variant_feed
from tests.test_queries import SF, db, plain  # noqa: F401 - a fixture

TOP = Path(queries.__file__).resolve().parent.parent
FEED, TRAINING = (json.loads(m.CONFIG.read_text()) for m in (variant_feed, training_tables))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"A": "a", "C": "e", "G": "i", "T": "o", "N": "r"}


def record(i, nt, source="s1", n_chars=9, lang="en"):
    return (i, "".join(LETTERS[c] for c in nt), lang, source, n_chars)


ATG, GCC = record(1, "ATG" * 20), record(2, "GCC" * 20, "s2")


def drop(spark, rows, path):
    spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(path)


def held(df):
    return Counter({(r.dataset, r.nt[:3], r.aa[:1], r.year, r.month): r.n for r in df.collect()})


def files(top):
    return {str(p): p.stat().st_mtime_ns for p in Path(top).rglob("part-*")}


@pytest.fixture
def feed(spark, tmp_path):
    docs, out, state = (f"{tmp_path}/{x}" for x in ("docs", "out", "state"))
    return docs, out, lambda: variant_feed.run(spark, docs, out, state, FEED)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, db, name):  # noqa: F811
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    res = db.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    assert plain(tuple(r[c] for c in columns) for r in df.collect()) == plain(tuple(r[names.index(c)] for c in columns) for r in res.fetchall())


def test_feed_takes_only_new_files(spark, tmp_path, feed, caplog):
    caplog.set_level(logging.INFO, "jobs")
    docs, out, run = feed
    table = spark.read.parquet(f"{SF}/documents.parquet")
    table.where("doc_id % 3 > 0").write.parquet(docs)
    run()
    table.where("doc_id % 3 = 0").write.mode("append").parquet(docs)
    found = run()
    want = duckdb.connect().execute(queries.ORACLES["job1_variant_feed"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")).fetchall()
    assert plain(tuple(r) for r in found.select("dataset", "nt", "aa", "year", "month", "n").collect()) == plain(want)
    said = [r.getMessage() for r in caplog.records if r.getMessage().startswith("read ")]
    n, third = table.count(), table.where("doc_id % 3 = 0").count()
    assert [int(x.split()[1]) for x in said] == [n - third, third]
    before = files(out)
    assert run().count() == found.count() and files(out) == before


def test_feed_leaves_other_datasets_alone(spark, feed):
    docs, out, run = feed
    drop(spark, [ATG, GCC, record(3, "", "s3"), record(4, "ATG" * 20, None), record(5, "ATG" * 20, "s1", None), (6, None, None, None, None)], docs)
    first = held(run())
    assert first == {("s1", "ATG", "M", 2015, 10): 1, ("s2", "GCC", "A", 2015, 10): 1, ("unknown", "ATG", "M", None, None): 1, ("s1", "ATG", "M", None, None): 1}
    before = files(f"{out}/counts")
    drop(spark, [record(7, "ATG" * 20), record(8, "GCC" * 20)], docs)
    assert held(run()) == first + Counter({("s1", "ATG", "M", 2015, 10): 1, ("s1", "GCC", "A", 2015, 10): 1})
    after = files(f"{out}/counts")
    assert {p for p in before if "dataset=s1" not in p} == {p for p in after if "dataset=s1" not in p} and all(after[p] == before[p] for p in before if "dataset=s1" not in p)


def test_feed_stopped_between_its_steps(spark, tmp_path, feed, monkeypatch):
    docs, out, run = feed
    drop(spark, [ATG, GCC], docs)
    run()
    drop(spark, [ATG], docs)
    # the increment is there, but the counts aren't
    with monkeypatch.context() as m:
        m.setattr(variant_feed, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert held(variant_feed.read_counts(spark, out))["s1", "ATG", "M", 2015, 10] == 1
    assert held(run())["s1", "ATG", "M", 2015, 10] == 2
    # a batch that isn't committed is taken again
    drop(spark, [ATG, GCC], docs)
    count = variant_feed.counts.count_variants
    with monkeypatch.context() as m:
        m.setattr(variant_feed.counts, "count_variants", lambda *a: count(*a).selectExpr("*", "raise_error('lost')"))
        with pytest.raises(Exception, match="lost"):
            run()
    want = {("s1", "ATG", "M", 2015, 10): 3, ("s2", "GCC", "A", 2015, 10): 2}
    assert held(run()) == want
    # a partition that was lost while it was replaced
    os.rename(f"{out}/counts/dataset=s1", f"{tmp_path}/lost")
    drop(spark, [GCC], docs)
    assert held(run()) == {**want, ("s2", "GCC", "A", 2015, 10): 3}


def test_training_tables(spark, tmp_path):
    lines = [(1, "2020-01-05", 2.0), (1, "2020-01-09", 3.0), (1, "1980-01-01", 4.0), (2, "2021-02-01", 1.0), (3, "2020-01-01", 9.0), (9, "2020-01-01", 5.0), (None, "2020-01-01", 5.0), (1, None, 1.0)]
    parts = [(1, "red cogs and all", "B1", "T", 4), (2, "abcdefghij", "B1", "T", 5), (3, "a b", "B1", "T", 6), (4, "", "B2", "T", 7), (5, "abc", "B3", "T", 8)]
    spark.createDataFrame(lines, "l_partkey long, d string, l_quantity double").selectExpr("l_partkey", "to_timestamp(d) l_shipdate", "l_quantity").write.parquet(f"{tmp_path}/t/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/t/part.parquet")
    made = [plain(tuple(r) for r in training_tables.run(spark, f"{tmp_path}/t", f"{tmp_path}/out", TRAINING).select("benchmark", "nt", "aa", "bin", "n", "total").collect()) for _ in range(2)]
    rows = [("5", "ABCDEFGHIJ", "2021-02", 1, 1)]  # 'red cogs and all' has 3 gaps in 16
    assert made[0] == made[1] == sorted((f"T_B1_{k}", *r) for k in (0, 1, 2) for r in rows)
    audit = {r.motif_tag: r for r in spark.read.parquet(f"{tmp_path}/out/audit").collect()}
    one = audit["B1"]
    assert set(audit) == {"B1", "B3"} and one.status == "OK" and audit["B3"].status != "OK"
    assert (one.variants_kept, one.variants_dropped_gapX, one.counts_kept, one.counts_dropped_gapX, one.counts_unknown) == (1, 2, 1, 19, 5)


def test_training_files_are_in_order(spark, tmp_path):
    training_tables.run(spark, SF, str(tmp_path), TRAINING)
    for folder in sorted((tmp_path / "training").glob("benchmark=*"))[:20]:
        totals = [r.total for f in sorted(folder.glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert totals and totals == sorted(totals, reverse=True)


def test_command_lines(tmp_path):
    env = {**os.environ, "PYTHONPATH": str(TOP)}
    for name, options in (("variant_feed", ["--records", f"{SF}/documents.parquet", "--checkpoint", f"{tmp_path}/state"]), ("training_tables", ["--tables", SF])):
        said = subprocess.run([sys.executable, str(TOP / f"jobs/{name}.py"), "--out", f"{tmp_path}/{name}", *options], env=env, capture_output=True, text=True, timeout=300)
        assert said.returncode == 0, said.stderr[-2000:]
        assert f"jobs.{name}" in said.stderr.replace("__main__", f"jobs.{name}") and "wrote" in said.stderr
    assert list(tmp_path.glob("variant_feed/counts/dataset=*/part-*")) and list(tmp_path.glob("training_tables/training/benchmark=*/part-*"))


def test_an_empty_sequence_has_no_motif(spark):
    rows = spark.createDataFrame([(1, "", "en", "s", 0), (2, None, "en", "s", None)], DOCS)
    assert variant_feed.fragments(rows, FEED).count() == 0
