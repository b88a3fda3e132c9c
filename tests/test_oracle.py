"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF

from fabula.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cur = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
