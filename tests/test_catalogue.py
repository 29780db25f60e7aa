"""Every registered query against its SQL twin on the smallest sample tables."""

import os

import pytest

import __spark_entry__ as entry_points
from wearline.catalogue.compare import difference, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_every_twin_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
