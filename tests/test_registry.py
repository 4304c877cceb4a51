"""Every registered job against its oracle, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return "null" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_job(spark, tables, name):
    frame = contract.queries()[name](spark, str(SF_DIR))
    got = sorted_rows(frame.columns, frame.collect())
    if name not in contract.oracle_sql():
        assert got
        return
    cursor = tables.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert got == sorted_rows(names, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
