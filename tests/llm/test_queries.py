"""Every registered query runs, and equals its SQL where it has one."""

import duckdb
import pytest

from conftest import DATA
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    got = QUERIES[name](spark, DATA)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, cur.fetchall()))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
