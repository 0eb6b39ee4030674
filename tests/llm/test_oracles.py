"""Queries that SQL can express equal their DuckDB oracles."""

import duckdb
import pytest

from rillflow.llm.oracles import ORACLES
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    got = REGISTRY[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(res.fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == want and want
