"""Every registered query equals its independent DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from rillflow.plans.queries import REGISTRY
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = df.collect()
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert _rows(df.columns, got) == _rows(cols, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["seq", "channel", "value"]
    counts = dict(df.groupBy("channel").count().collect())
    assert set(counts) == {"err", "start", "page", "display", "action"}
