"""Every registered query against its checking SQL."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

CHECKS = contract.oracle_sql()
# those of the training-text operators, where they are installed, have tests of their own
OWN = [n for n in contract.queries() if not (contract.llm and (n in contract.llm.QUERIES or n == "pipeline"))]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_is_checked():
    assert set(OWN) <= set(CHECKS)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, sf_dir, name):
    assert compare(contract.queries()[name](spark, sf_dir), con, CHECKS[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 45
