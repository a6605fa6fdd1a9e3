"""Plan-shape assertions for every registered query (no execution needed)."""

import pytest

from layerwise.plans.catalogue import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


@pytest.mark.parametrize("name", ["team_performance", "season_stats", "key_violations", "top_teams"])
def test_aggregations_combine_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "partial_" in plan  # map-side partial aggregation


@pytest.mark.parametrize("name", ["dedup_keep_one", "clean_contests", "clean_schedule", "latest_snapshot"])
def test_keep_one_limits_rows_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quality_counts_by_hash_aggregates(spark):
    plan = _plan(QUERIES["quality_profile"](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert "SortAggregate" not in _plan(QUERIES["clean_history"](spark, SF_SMALL))


def test_report_is_not_sorted_and_the_limit_is_below_the_joins(spark):
    assert "rangepartitioning" not in _plan(QUERIES["prediction_report"](spark, SF_SMALL))
    narrow = _plan(QUERIES["predict_contests_narrow"](spark, SF_SMALL))
    assert narrow.count("TakeOrderedAndProject") == 2
    assert narrow.index("Join") < narrow.rindex("TakeOrderedAndProject")


def test_upsert_reads_the_incoming_rows_once(spark):
    from layerwise.operators.upsert import upsert
    from layerwise.plans import fixtures as fx

    incoming = fx.table(spark, SF_SMALL, "supplier").selectExpr("s_suppkey as k", "s_nationkey as v")
    current = spark.range(10).selectExpr("id as k", "id as v")
    plan = _plan(upsert(current, incoming, "k"))
    assert plan.count("FileScan") == 1


def test_no_broadcast_is_forced(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("team_performance", "normalise_names_by_table", "predict_contests_named"):
            assert "Broadcast" not in _plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["team_performance"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in plan


@pytest.mark.parametrize("name,joins", [("predict_pair_named", 2), ("predict_contests_named", 2)])
def test_schedule_meets_names_once_per_side(spark, name, joins):
    """Joins above the schedule (its date is the only column that nothing else carries)."""
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    deepest = max((i for i, line in enumerate(lines) if "Relation" in line and "o_orderdate" in line
                   and line.lstrip(" :").startswith("+-")), key=lambda i: -i)
    above, level = 0, depth[deepest]
    for i in range(deepest, -1, -1):
        if depth[i] < level:
            level = depth[i]
            above += "Join" in lines[i]
    assert above == joins


def test_rank_lookup_joins_contests_once(spark):
    df = QUERIES["rank_lookup_fallback"](spark, SF_SMALL)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    top = [line.strip(" :+-") for line in lines[:6]]
    assert sum("Join LeftOuter" in line for line in top) == 1
    assert sum("l_linenumber" in line and "Relation" in line for line in lines) == 1  # contests are derived once


def test_quality_profile_derives_contests_once_and_sorts_nothing_but_the_log(spark):
    df = QUERIES["quality_profile"](spark, SF_SMALL)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Relation" in line and "l_linenumber" in line for line in lines) == 1
    assert "Window" not in _plan(df) and "SortAggregate" not in _plan(df)
