"""The physical plans are the intended ones."""

import pytest

from checks import registered
from tests.test_queries import SF_DIR

UNWANTED = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]


def tree(plan):
    return plan.split("\n\n")[0]


@pytest.mark.parametrize("name", ["station_summary", "nearest_weather_grid", "nearby", "series_json_explode", "quality_report"])
def test_no_python_and_no_cross_join(spark, plan_of, name):
    plan = plan_of(registered.QUERIES[name](spark, SF_DIR))
    assert not [operator for operator in UNWANTED if operator in plan]


def test_small_weather_is_broadcast_and_readings_are_not_shuffled_for_it(spark, plan_of):
    plan = tree(plan_of(registered.nearest_weather(spark, SF_DIR)))
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan and "SortMergeJoin" not in plan
    # One exchange of readings, for the latest ingest; the weather side has its own two and the broadcast.
    left = plan[: plan.index("BroadcastExchange")]
    assert left.count("Exchange") == 1


def test_events_scan_reads_only_the_columns_it_needs(spark, plan_of):
    plan = plan_of(registered.station_summary(spark, SF_DIR))
    schemas = [line for line in plan.split("\n") if line.startswith("ReadSchema")]
    assert schemas and not [s for s in schemas if "props" in s]


def test_pivot_aggregates_before_its_only_exchange(spark, plan_of):
    plan = tree(plan_of(registered.conditional_pivot(spark, SF_DIR)))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
