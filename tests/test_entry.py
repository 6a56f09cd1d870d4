"""The driver's functions, with and without the training-data part."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from kornverk.plans import catalogue

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@needs_data
def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_core_does_not_import_llm():
    code = "import sys; sys.modules['kornverk.llm'] = None; import __spark_entry__ as e; assert 'vocab_rank' in e.queries() and not any(q[0] == 'p' and q[1].isdigit() for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


@needs_data
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
