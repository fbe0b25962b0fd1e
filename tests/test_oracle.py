"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as driver
from spendlake.queries.cleaning import QUERIES as CLEANING
from spendlake.queries.loading import QUERIES as LOADING
from spendlake.queries.resolving import QUERIES as RESOLVING

QUERIES = {**CLEANING, **RESOLVING, **LOADING}
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, plan, name):
    df = driver.queries()[name](spark, SF)
    assert differences(df, con, driver.oracle_sql()[name]) == []
    # No query may pair all rows of two tables.
    assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_operator_has_a_query():
    have = {query.operator for query in QUERIES.values()}
    assert set(QUERIES) <= set(driver.queries())
    groups = {"S": 8, "P": 19, "F": 5, "R": 2, "J": 11, "U": 4, "A": 5, "O": 2, "T": 4, "D": 7, "L": 11}
    assert have == {f"{letter}{n}" for letter, last in groups.items() for n in range(1, last + 1)}
