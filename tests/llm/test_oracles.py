"""The registered queries against their SQL, on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from fieldcat.llm.oracle import ORACLE
from fieldcat.llm.queries import QUERIES
from tools.check_oracle import digest


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    mine, plain = QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(ORACLE[name]).fetchdf()
    assert sorted(mine.columns) == sorted(plain.columns)
    whole = [c for c in mine.columns if plain[c].dtype.kind in "iu"]  # a column with nulls comes as floats
    mine[whole] = mine[whole].astype("Int64")
    assert digest(mine) == digest(plain)


def test_every_operator_is_registered():
    names = se.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(se.oracle_sql())
