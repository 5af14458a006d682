"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import check

# Training three boosted models takes minutes; the comparer runs this one.
SLOW = {"horizon_compare"}


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query_equals_sql(spark, con, small, name):
    problem = check(spark, con, small, name, entry.queries()[name], entry.oracle_sql().get(name))
    # a thousand readings hold no run or alert of some kinds
    assert problem in (None, "equal but empty")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["window_start", "window_end"]
