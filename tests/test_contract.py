"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from contract.check import compare, connect
from contract.oracle import ORACLE_SQL as ORACLE
from contract.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], ORACLE[name], SF) == ""
