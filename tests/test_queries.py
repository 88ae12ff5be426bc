"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, difference

SF = "/root/testdata/sf0.001"
from parcelflow.oracles import ORACLES  # noqa: E402
from parcelflow.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
