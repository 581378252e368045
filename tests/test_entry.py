"""Driver contract: entry() runs; every SQL oracle agrees with its Spark query on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from metrolens.plans import registry

from .conftest import SF_SMALL

ROWS_ONLY = {"pickup_clusters_ml"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("physical_id", "int"), ("the_geom", "string"), ("tickets", "bigint")]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    q, o = ({n for n in x if n in registry.all_queries()} for x in (entry.queries(), entry.oracle_sql()))
    assert o <= q
    assert q - o == ROWS_ONLY


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "documents", "pages", "labels"]:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert len(df.collect()) > 0
