"""The driver's contract: the entry module, with and without its optional part, and every query against its SQL."""

import datetime
import decimal
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from rankwell.plans.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    return value.isoformat() if isinstance(value, datetime.date) else value


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    expected = oracle.sql(SQL[name])
    assert sorted(expected.columns) == columns
    assert in_order(frame.select(*columns).collect()) == in_order(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 5


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_everything_else_works_without_the_optional_part():
    code = "import sys; sys.modules['rankwell.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not [n for n in e.queries() if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
