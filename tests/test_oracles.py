"""Every query with an SQL counterpart gives the same rows as DuckDB on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracles  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="module")
def con(request):
    from conftest import SF_DIR

    connection = check_oracles.connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    outcome = check_oracles.compare(spark, con, sf_dir, name)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 150


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
