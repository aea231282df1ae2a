"""Every query with a DuckDB twin gives the twin's rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from colophon import demo

DIR = "/root/testdata/sf0.001"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(demo.ORACLES))
def test_twin(spark, duck, name):
    df = demo.QUERIES[name](spark, DIR)
    cur = duck.execute(demo.ORACLES[name])
    want = rows([c[0] for c in cur.description], cur.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0]
    assert got[1] == want[1], (list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3])


def test_entry(spark):
    assert {r["nation"] for r in entry.entry(spark).collect()}
