"""Every registered query against its SQL counterpart, values equal to the last digit."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.comparison import connect, differences

SF_DIR = os.environ.get("LEDGERLENS_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.library_queries(), entry.library_oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
