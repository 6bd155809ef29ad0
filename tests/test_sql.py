"""Every registered query against its SQL, and every other query for rows."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from ledgerloom.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
ROWS_ONLY = [n for n in QUERIES if n not in SQL]
# fits of a minute and more: `python tests/oracle.py` compares them too, and test_runs has small ones
SLOW = {"train_xgboost", "random_search"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_same_rows(spark, con, name):
    assert compare(con, SQL[name], QUERIES[name](spark, SF)) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert "bureau__row_count" in contract.entry(spark).columns
