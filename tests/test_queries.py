"""The driver contract on the smallest tables: every query with SQL equals DuckDB."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, rows_of
from conftest import TESTDATA

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("pipeline", ["kept", "deleted"])
def test_the_library_stands_without_the_training_data_operators(tmp_path, pipeline):
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", *["corpus_pipeline.py"] * (pipeline == "deleted"))
    shutil.copytree(Path(contract.__file__).parent, tmp_path / "copy", ignore=gone)
    names = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", names], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    left = done.stdout.split()
    assert left == sorted(n for n in QUERIES if not n.startswith("op") and n != "pipeline") and len(left) > 50


def test_entry(spark):
    report = contract.entry(spark)
    assert report.columns[:2] == ["date", "region"] and report.count() > 0
