"""Every registered query beside its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect
from workload.oracles import ORACLES
from workload.queries import REGISTERED

WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", REGISTERED)
def test_query(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir) is None


def test_every_query_has_sql_or_a_reason():
    assert set(REGISTERED) - set(ORACLES) == WITHOUT_SQL


def test_the_contract_has_every_query():
    assert set(REGISTERED) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["region", "nb_deces"] and found.count() > 0
