"""Every registered query with a SQL twin equals DuckDB on the sf0.001 tables
(the driver repeats this at sf0.01); queries without a twin must run."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if v is None:
        return "null"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["item_id", "n_hits", "context", "prompt"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    if name not in ORACLE:
        assert srows is not None
        return
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)
