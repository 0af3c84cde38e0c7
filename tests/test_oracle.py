"""Every registered query against its SQL oracle (DuckDB) at sf0.01; queries
without SQL must at least run and keep a stable schema."""

import pytest

from conftest import SF_ORACLE
from oracle_compare import compare, duck
from tessera import plans

QUERIES = plans.queries()
ORACLE = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    schema = df.schema
    assert df.count() >= 0
    assert QUERIES[name](spark, SF_ORACLE).schema == schema


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = {r["lang"]: r for r in df.collect()}
    assert sum(r["n_chunks"] for r in rows.values()) == 744  # FIXTURES: sf0.001 -> 744 chunks
    assert all(r["dimensions"] == 768 for r in rows.values())
    assert set(E.oracle_sql()) <= set(E.queries())
