"""Every query against its SQL on the smallest tables."""

import pytest
from compare import duck, rows

from textloom.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, data, name):
    ours, theirs = QUERIES[name](spark, data).toPandas(), con.execute(ORACLES[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(entry.queries())
