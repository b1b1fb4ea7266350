"""Every registered query against its SQL, on the smallest tables."""

import datetime
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tapeloom.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in Path(SF).iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    want = duck.sql(SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    cols = want.columns
    assert sorted(tuple(plain(r[c]) for c in cols) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_imports_without_a_session():
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=root, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
