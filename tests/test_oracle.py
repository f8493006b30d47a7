"""Each registered query against its SQL twin on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import compare
from roadpulse import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, tables, name):
    rows = catalog.queries()[name](spark, SF_DIR)
    assert compare.differences(rows, tables, catalog.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())


def test_entry_has_rows_and_gold_columns(spark):
    rows = contract.entry(spark)
    assert rows.columns == [
        "window_start",
        "window_end",
        "type_code",
        "road",
        "event_count",
        "avg_delay_seconds",
    ]
    assert not rows.isEmpty()
