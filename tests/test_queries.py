"""Every query with a SQL counterpart gives the same rows."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import normal

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    con = duckdb.connect()
    for f in Path(tiny).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "rank", "term", "score"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, tiny, con, name):
    got, want = entry.queries()[name](spark, tiny).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
