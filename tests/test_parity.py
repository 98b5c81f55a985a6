"""Every registered query gives the rows its SQL gives."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import parity  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from conftest import SF  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return parity.duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, text = parity.compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, text


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "contact_id" and df.count() > 0
