"""Every catalogued query against its DuckDB oracle on the smallest test scale."""

import pytest

from shopwright.plans import catalog, crosscheck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return crosscheck.duck(SF)


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = crosscheck.compare(spark, SF, name, con)
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
