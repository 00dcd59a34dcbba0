"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from kpiloom.plans.oracle import ORACLE
from kpiloom.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, repr(v))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "net_revenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                   "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    o_types = {c: str(t).replace(" ", "") for c, t in zip(rel.columns, rel.types)}
    s_types = {f: (t.upper().replace(" ", "") if t.startswith("decimal") else SPARK_TO_DUCKDB.get(t, t))
               for f, t in sdf.dtypes}
    assert s_types == o_types                     # same column names and types
    cols = sorted(sdf.columns)
    s_rows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(ORACLE[name])
    o_names = [d[0] for d in cur.description]
    assert sorted(o_names) == cols
    o_rows = sorted(tuple(_norm(dict(zip(o_names, r))[c]) for c in cols) for r in cur.fetchall())
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
