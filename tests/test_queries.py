"""Every registered query against its DuckDB check on the smallest test tables."""

from __future__ import annotations

import oracle
import pytest
from conftest import SMALL

import __spark_entry__
from duesmith import schema
from duesmith.plans import catalog
from duesmith.sources import billing_views

QUERIES = catalog()


@pytest.fixture(scope="module")
def connection():
    return oracle.duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(name, small, connection):
    spark_columns, duck_columns, actual, expected = oracle.check(connection, QUERIES[name], small)
    assert spark_columns == duck_columns
    assert actual == expected


@pytest.mark.parametrize("name", sorted(billing_views.VIEWS))
def test_view_matches_declared_schema(name, small):
    declared = [part.rsplit(" ", 1) for part in schema.TABLES[name].replace(", ", "\n").split("\n")]
    assert [[f.name, f.dataType.simpleString()] for f in small[name].schema] == declared


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql())


def test_entry_is_lazy_and_runs(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
