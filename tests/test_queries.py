"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import compare, registry
from classmap.plans.settle import scratch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert registry.QUERIES.items() <= entry.queries().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    with scratch(spark):
        df = registry.QUERIES[name](spark, SF_DIR)
        assert compare.compare(df, duck, registry.ORACLES[name]) == []
