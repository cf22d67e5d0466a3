import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakemoor.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows):
    return sorted((tuple("nan" if isinstance(v, float) and v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_catalogue(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = canonical(tuple(r[c] for c in columns) for r in df.collect())
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    assert got == canonical(rel.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def bare(tmp_path):
    """The repository as it is with the training-data operators' folders deleted."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "lakemoor", tmp_path / "lakemoor", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(root / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    return tmp_path


def run(where, *command):
    return subprocess.run([sys.executable, *command], cwd=where, env=os.environ | {"PYTHONPATH": str(where)}, capture_output=True, text=True, timeout=250)


def test_works_without_the_training_data_operators(tmp_path):
    out = run(bare(tmp_path), "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], out.stderr
    out = run(tmp_path, "-m", "pytest", "tests", "-q", "-x", "--collect-only")
    assert out.returncode == 0, out.stdout
    out = run(tmp_path, "-m", "pytest", "tests/test_datasets.py", "-q", "-x", "-k", "versions or modes or storage_options")
    assert out.returncode == 0, out.stdout


def test_broken_dependencies_are_not_swallowed(tmp_path):
    llm = bare(tmp_path) / "lakemoor" / "llm"
    llm.mkdir()
    (llm / "__init__.py").touch()
    (llm / "queries.py").write_text("import no_such_library")
    out = run(tmp_path, "-c", "import __spark_entry__")
    assert out.returncode and "no_such_library" in out.stderr
