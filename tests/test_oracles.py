"""Every registered query against its DuckDB oracle on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql  # noqa: E402
from sluice.plans.queries import QUERIES  # noqa: E402
from check_oracles import _digest, _kind  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    ocols, otypes = list(rel.columns), [_kind(t) for t in rel.types]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert {c: _kind(t) for c, t in df.dtypes} == dict(zip(ocols, otypes))
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "event_id" in df.columns
