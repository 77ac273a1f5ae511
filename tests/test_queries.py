"""Every query with SQL gives the same rows as DuckDB, and every other one runs, on the smallest tables."""

import os

import duckdb
import pytest

from millrace import queries as Q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted(repr([value(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    rows = got.collect()
    if name in Q.SQL:
        want = duck.execute(Q.SQL[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(got.columns)
        assert plain(rows, got.columns) == plain(want.fetchall(), names)
    else:
        assert rows
