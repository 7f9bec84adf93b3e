"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest
from compare import compare, oracle

from __spark_entry__ import entry, oracle_sql, queries
from pulsegrid.plans import queries as registry


@pytest.fixture(scope="module")
def db(sf):
    return oracle(sf)


def test_entry(spark):
    assert entry(spark).count() == 5


def test_every_query_of_the_engine_has_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, sf, name):
    assert compare(queries()[name](spark, sf), db, oracle_sql()[name]) == ""
