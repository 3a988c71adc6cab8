"""Every registered query against its SQL at the smallest scale; the rest must return rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# The queries of the llm package have their own tests.
ORACLES, QUERIES = entry.ORACLES, entry.QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 6
