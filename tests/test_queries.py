"""Every registered query against its SQL, whole results, both small sizes."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from verification.compare import compare, connect
from verification.oracles import ORACLES as SQL
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 60
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], SQL[name], SMALL) == ""


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
