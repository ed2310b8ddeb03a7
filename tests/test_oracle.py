"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from tools.compare import connect, difference
from workload import batch, files, streams

KEYS = list(entry.queries())
WITHOUT_SQL = sorted(set(KEYS) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    """Other queries have tests of their own where SQL cannot express them."""
    own = {**batch.QUERIES, **files.QUERIES, **streams.QUERIES}
    assert set(own) <= set(entry.oracle_sql()) <= set(KEYS)


@pytest.mark.parametrize("key", [k for k in KEYS if k not in WITHOUT_SQL])
def test_same_rows(spark, con, key):
    problem, _ = difference(spark, con, SF, key)
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
