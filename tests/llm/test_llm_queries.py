"""Registered queries: all rows of their tables, and the same as their SQL where it can express them."""

from __future__ import annotations

import pytest
from compare import compare, oracle

from pulsegrid.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, db, sf, name):
    assert compare(QUERIES[name](spark, sf), db, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_every_row(spark, sf, name):
    table, key = ("pages", "page_id") if name.startswith("pages") else ("documents", "doc_id")
    rows = QUERIES[name](spark, sf).select(key).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect()))
