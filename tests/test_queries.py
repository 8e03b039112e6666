"""Every registered query against its SQL twin."""

import pytest

from checks.queries import registry
from checks.run import connect, differences

REGISTRY = registry()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, duck, sf_dir, name):
    query, sql = REGISTRY[name]
    got = query(spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, duck.execute(sql).df()) == []


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1
