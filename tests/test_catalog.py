"""Every catalogue query against its SQL twin in DuckDB."""

from __future__ import annotations

import os

import oracle_compare
import pytest

import __spark_entry__ as entry_module
from panelloom.plans.catalog import QUERIES
from panelloom.plans.oracle import ORACLE

SF_DIR = os.environ.get("PANELLOOM_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = oracle_compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_names_agree():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry_module.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    assert oracle_compare.differences(df, duck, entry_module.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
