"""Every query of the library against its SQL on the smallest tables."""

import pytest

from tallyforge.plans.registry import ORACLE, QUERIES
from tests.conftest import SF, same


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    same(QUERIES[name](spark, SF), duck.sql(ORACLE[name]))


@pytest.mark.parametrize("name", ["o01_latest_results", "o02_export_order"])
def test_whole_order(spark, duck, name):
    """All rows come, in the oracle's order."""
    whole = duck.sql(ORACLE[name])
    found = QUERIES[name](spark, SF).select(*whole.columns).collect()
    assert len(found) > 200 and [tuple(map(str, r)) for r in found] == [tuple(map(str, r)) for r in whole.fetchall()]


def test_source_sizes_without_a_window(spark):
    plan = QUERIES["a23_source_sizes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
