"""Plan-shape guards for the scale design, over every registered query."""

import pytest

import __spark_entry__ as E

QUERIES = E.queries()
FORBIDDEN = {
    "CartesianProduct": "cross product",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF in the hot path",
    "percentile(": "group-at-once exact percentile aggregate",
    "percentile_cont(": "group-at-once exact percentile aggregate",
    "median(": "group-at-once median aggregate",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def cut_plans():
    """Plans of the frames that checkpoints write on the way, which the last plan no longer shows."""
    from loyalflow import session

    plans = []

    def see(df):
        plans.append(plan_of(df))

    session.ON_CUT.append(see)
    yield plans
    session.ON_CUT.remove(see)


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rfm_aggregates_before_the_customers_are_joined(spark, sf_small, no_auto_broadcast):
    plan = plan_of(QUERIES["rfm_aggregate"](spark, sf_small)).split("\n")
    at = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
    assert sum("HashAggregate" in line for line in plan[at:]) == 2  # partial and final, below the join


def test_group_statistics_are_broadcast_to_the_rows(spark, sf_small, no_auto_broadcast):
    plan = plan_of(QUERIES["outlier_columns"](spark, sf_small))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, sf_small, cut_plans, name):
    plans = [plan_of(QUERIES[name](spark, sf_small)), *cut_plans]
    bad = [why for token, why in FORBIDDEN.items() if any(token in p for p in plans)]
    assert not bad, f"{name}: {bad}"


def test_profile_has_no_expand(spark, sf_small):
    plan = plan_of(QUERIES["purchase_profile"](spark, sf_small))
    assert "Expand" not in plan


def test_transaction_scan_is_pruned_and_filtered(spark, sf_small):
    df = QUERIES["rfm_aggregate"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_deleted), EqualTo(is_deleted,0)" in plan


def test_read_schema_is_pruned(spark, sf_small):
    df = QUERIES["valid_transactions"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.split("\n") if "ReadSchema" in line]
    assert schemas and all("amount_earned_point" not in s for s in schemas)
