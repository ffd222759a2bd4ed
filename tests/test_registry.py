"""Every registered query against its SQL, on the smallest tables."""

import inspect
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from checks import compare, oracles, queries

SF = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(SQL) == set(queries.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert entry_points.entry(spark).columns[:3] == ["event_date", "video_id", "total_comments"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(spark, con, SF, name, SQL[name]) == ""


def test_no_query_limits_its_input():
    source = inspect.getsource(queries)
    assert ".limit(" not in source and ".sample(" not in source and ".collect(" not in source
