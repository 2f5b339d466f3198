"""Plan shape checks on the parquet bindings."""

from __future__ import annotations

import pytest

from murmuration import queries
from murmuration.plans import plan_string, python_nodes, scan_details

from conftest import sf_dir


@pytest.fixture(scope="module")
def sf():
    return sf_dir("0.001")


FILTERED = {"q08_members_filtered", "q11_outsiders_filtered"}  # a filter's bits are tested in Arrow batches


@pytest.mark.parametrize("name", sorted(queries.SOCIAL_QUERIES))
def test_social_plans_stay_in_the_jvm(spark, sf, name):
    df = queries.SOCIAL_QUERIES[name](spark, sf)
    assert (python_nodes(df) == []) == (name not in FILTERED)
    text = plan_string(df, "simple")
    # the only cartesian products allowed are none at all
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_q02_uses_take_ordered(spark, sf):
    text = plan_string(queries.q02(spark, sf), "simple")
    assert "TakeOrderedAndProject" in text
    assert "Sort [" not in text.split("TakeOrderedAndProject")[1].split("Exchange")[0]


def test_q11_anti_join(spark, sf):
    assert "LeftAnti" in plan_string(queries.q11(spark, sf), "simple")


@pytest.mark.parametrize("q", ["q07", "q08"])
def test_neglect_scans_events_twice(spark, sf, q):
    # one scan for the friend edges, one for the visits; owners come from the
    # same per-owner aggregate, not from a third scan
    scans = scan_details(getattr(queries, q)(spark, sf))
    assert sum("events" in s.get("Location", "") for s in scans) == 2


def test_event_filters_reach_the_scan(spark, sf):
    scans = scan_details(queries.q11(spark, sf))
    ev = [s for s in scans if "events" in s.get("Location", "")]
    assert ev and all("event_type" in s["PushedFilters"] for s in ev)
    # column pruning: the events scan never reads value or event_id here
    assert all("value" not in s["ReadSchema"] for s in ev)


def test_q06_reads_only_needed_columns(spark, sf):
    scans = scan_details(queries.q06(spark, sf))
    (ev,) = [s for s in scans if "events" in s.get("Location", "")]
    assert "ts" not in ev["ReadSchema"] and "event_id" not in ev["ReadSchema"]


def test_q12_counts_run_as_scalar_subqueries(spark, sf):
    text = plan_string(queries.q12(spark, sf), "formatted")
    assert "Subquery" in text and "CartesianProduct" not in text


def test_q17_runs_the_argmin_once(spark, sf):
    # no join on the computed center id: a join would infer a null filter on
    # it, push it below the projection and evaluate the argmin twice
    from murmuration.queries_kmeans import q17
    text = plan_string(q17(spark, sf), "simple")
    assert text.count("ArrowEvalPython") == 1
    assert "Exchange" not in text and "Join" not in text


def test_q13_mean_reuses_the_degree_aggregate(spark, sf):
    df = queries.q13(spark, sf)
    df.collect()
    final = plan_string(df, "simple").split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_operator_names(spark, sf):
    from murmuration.plans import operator_names
    names = operator_names(queries.q02(spark, sf))
    assert "TakeOrderedAndProject" in names and "BroadcastHashJoin" in names


def test_plan_summary_reads_the_final_plan(spark, sf):
    from murmuration.plans import plan_summary
    from murmuration.queries_kmeans import q19
    assert plan_summary(q19(spark, sf), execute=True)["shuffles"] == 1   # one reused subquery
    s13 = plan_summary(queries.q13(spark, sf), execute=True)
    assert s13["shuffles"] == 3 and s13["python_nodes"] == 0
