"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as se
from fieldcat.plans.oracle import ORACLE
from fieldcat.plans.queries import QUERIES
from tools.check_oracle import digest

duckdb = pytest.importorskip("duckdb")



@pytest.fixture(scope="module")
def con():
    from fieldcat.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in {"file_inventory", "datablocks"}))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toPandas()
    dd = con.execute(ORACLE[name]).fetchdf()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert digest(sp) == digest(dd)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "pid" in df.columns
