"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from ticklake import registry
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_and_is_an_entry():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    rows, problems = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id_episodio", "nombre_episodio", "id_mapa"]
