"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR

import __spark_entry__ as registered
from dqtable.plans.oracle import ORACLE
from dqtable.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_flagship(spark):
    rows = {r.client_id: r for r in registered.entry(spark).collect()}
    assert sum(r.original_rows for r in rows.values()) == 158
    assert sum(r.final_rows for r in rows.values()) == 29


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(duck, ORACLE[name])
