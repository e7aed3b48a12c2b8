"""T-oracle: every query with SQL equals DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tillpoint.sources.tables import TABLES


def _canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else repr(round(float(v), 9)))
    return (3, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "revenue" in df.columns


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    cur = con.execute(oracle_sql()[key])
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b = _rows([d[0] for d in cur.description], cur.fetchall())
    assert a[0] == b[0]
    assert a[1] == b[1]


@pytest.mark.parametrize("key", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, key):
    assert queries()[key](spark, SF_SMALL).count() >= 0
