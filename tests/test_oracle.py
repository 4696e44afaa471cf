"""Every query of the core against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from linkweave.plans.oracle import ORACLE
from linkweave.plans.queries import QUERIES


def cell(v):
    return "~" if v is None else f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


def compare(spark, sf, query, sql):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    df = query(spark, sf)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(cell(v) for v in r) for r in cur.fetchall())
    got = sorted(tuple(cell(r[n]) for n in names) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, QUERIES[name], ORACLE[name])


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)
