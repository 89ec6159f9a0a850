import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from check_oracle import TABLES, table
from registry.oracle import ORACLE
from registry.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) == set(ORACLE)


def test_entry_without_the_optional_part(tmp_path):
    """The tree without the operators on training data, with and without the pipeline's file."""
    root = Path(registered.__file__).parent
    tree = tmp_path / "tree"
    optional = ("quillrank/llm", "tests/llm")
    shutil.copytree(
        root,
        tree,
        ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(f"{folder}/{n}", root) in optional],
    )
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert set(e.oracle_sql()) == set(e.queries()) and "pipeline" not in e.queries()
assert e.queries()["tokenize"](spark, "%s").count()
""" % SF
    for drop in (None, tree / "corpus_pipeline.py"):
        if drop:
            drop.unlink(missing_ok=True)
        run = subprocess.run([sys.executable, "-c", code], cwd=tree, env={**os.environ, "PYTHONPATH": str(tree)}, capture_output=True, text=True, timeout=300)
        assert run.returncode == 0, run.stderr[-2000:]


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, database, key):
    frame = registered.queries()[key](spark, SF)
    rows = frame.collect()
    assert rows
    if key in registered.oracle_sql():
        cursor = database.execute(registered.oracle_sql()[key])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(frame.columns)
        assert table(frame.columns, rows) == table(names, cursor.fetchall())
