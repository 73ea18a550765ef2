"""The folder's queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from selenite.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, DATA).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(tuple, got[cols].astype(str).to_numpy().tolist())) == sorted(map(tuple, want[cols].astype(str).to_numpy().tolist()))
