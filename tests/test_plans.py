"""Physical-plan guards for the scale properties the design relies on."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = ["covisit_clicks", "covisit_pair_weights", "predictions_all", "predictions_time_split", "ranker_frame",
           "weighted_recall", "time_split", "session_sample", "aid_coverage", "val_history"]


def _plan(spark, name: str) -> str:
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_sort_aggregate_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    for bad in ("SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_recency_cap_and_top_k_are_group_limited(spark):
    plan = _plan(spark, "covisit_clicks")
    assert plan.count("WindowGroupLimit") >= 4  # partial + final, for the cap and for the top-k
