"""Every catalogue query against its SQL in DuckDB."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import comparable
from rillstone.plans import CATALOG

QUERIES = {key: query.run for key, query in CATALOG.items()}
SQL = {key: query.oracle for key, query in CATALOG.items() if query.oracle}
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf, db, key):
    got = QUERIES[key](spark, sf).toPandas()
    want = db.execute(SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["itemId", "window_end", "cnt", "row_num"]


def test_python_workers_need_no_installation(sf, tmp_path):
    """User functions reach the workers from a session started elsewhere, with plain settings."""
    script = f"""
import sys; sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for key in ("aggregate_function_surface", "udtf_split_user", "partition_setup_map"):
    print(key, entry.queries()[key](spark, {sf!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("\n") == 3
