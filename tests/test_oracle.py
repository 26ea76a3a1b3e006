"""Every registered query next to its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from sensorspan.registry import QUERIES

from .compare import difference, oracle

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
