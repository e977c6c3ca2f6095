"""Every query beside the SQL that states its result, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from verification.check import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, oracle, name):
    frame = entry.queries()[name](spark, SF_DIR)
    if name in entry.oracle_sql():
        assert difference(frame, oracle, entry.oracle_sql()[name]) == ""
    else:
        assert frame.count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 956
