"""Every registered query against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from workload.base import RUNNERS, canonical
from workload.inputs import TABLES

QUERIES = {name: q for name, q in entry.queries().items() if name in RUNNERS}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in RUNNERS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    yield con
    con.close()


def _value(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return None if isinstance(v, float) and v != v else v


def _bag(rows, names, order):
    at = [names.index(c) for c in order]
    return Counter(tuple(_value(r[k]) for k in at) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(steps, duck, name):
    # the pipeline tables are shared here; `entry` below runs a query on its own
    df = canonical(RUNNERS[name](steps))
    got = df.collect()
    if name not in SQL:
        return
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    have, want = _bag(got, df.columns, order), _bag(cur.fetchall(), names, order)
    assert have == want, (list((have - want).items())[:3], list((want - have).items())[:3])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns
