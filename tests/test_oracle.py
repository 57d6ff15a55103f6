"""Every registered query vs its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture()
def con():  # one connection per key: a fatal DuckDB error cannot cascade
    c = duckdb.connect()
    for v in VIEWS:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return c


def test_registry_covers_oracle():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=key)
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=key)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "net_monthly_mrr" in df.columns


@pytest.mark.parametrize("name", ["n5_split", "n5_random_forest", "n5_class_report",
                                  "n5_importances", "n5_auc"])
def test_model_queries_run(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() > 0
