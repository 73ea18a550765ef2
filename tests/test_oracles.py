"""Every relational and raster query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

from selenite.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    text = frame[cols].convert_dtypes().astype(str).replace({"None": "NULL", "nan": "NULL", "<NA>": "NULL", "NaN": "NULL"})
    return cols, sorted(map(tuple, text.to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(registry.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).columns
