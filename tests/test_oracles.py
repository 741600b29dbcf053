"""Every query against its SQL; ``KERBLINE_SF`` picks the scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

SF_DIR = f"/root/testdata/sf{os.environ.get('KERBLINE_SF', '0.001')}"
ORACLES, QUERIES = oracle_sql(), queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert compare(spark, connection, name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r["year"] for r in rows] == sorted(r["year"] for r in rows)
    assert rows[0]["absolute_change"] is None
