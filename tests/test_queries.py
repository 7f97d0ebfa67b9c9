import os

import duckdb
import pytest

from jobs import queries as jobs
from tidemark import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables aren't here")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, db, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(tuple(r[c] for c in columns) for r in df.collect())
    if name not in queries.ORACLES:
        assert got
        return
    res = db.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    assert got == plain(tuple(r[names.index(c)] for c in columns) for r in res.fetchall())


def test_entry_survives_without_the_llm_folder(tmp_path):
    """In a copy of the repository without the folders and the pipeline, the entry imports and has all of the engine's queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(queries.__file__).resolve().parent.parent
    shutil.copytree(top / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(top / "jobs", tmp_path / "jobs")
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names, oracles = (set(line.split()) for line in said.stdout.splitlines()[-2:])
    assert names == set(queries.QUERIES) | set(jobs.QUERIES) and oracles == set(queries.ORACLES) | set(jobs.ORACLES)
