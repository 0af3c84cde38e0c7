"""Every query of the subpackage that has SQL against DuckDB over whole tables."""

import pytest

from conftest import SF_ORACLE
from oracle_compare import compare, duck
from tessera import llm


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_matches_sql(spark, con, name):
    ok, msg = compare(llm.queries()[name](spark, SF_ORACLE), con, llm.oracle_sql()[name])
    assert ok, f"{name}: {msg}"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
