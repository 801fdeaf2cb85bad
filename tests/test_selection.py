"""Percentiles by distributed selection, and divisions that must not end a run."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loyalflow import session
from loyalflow.operators import churn_model as cm
from loyalflow.operators.selection import percentiles

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p83": 0.83, "p100": 1.0}


def check(spark, pdf, **more):
    got = percentiles(spark.createDataFrame(pdf), ["g"], "v", PROBS, **more).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g")["v"].quantile(list(PROBS.values())).unstack()
    assert list(got.index) == list(want.index)
    for name, p in PROBS.items():
        assert np.allclose(got[name], want[p], rtol=1e-12, atol=0), name


def test_many_sizes_and_shapes(spark):
    rng = np.random.default_rng(5)
    parts = [("normal", rng.normal(size=5000)), ("ties", rng.integers(0, 4, 3000).astype(float)), ("one", np.array([3.5])),
             ("two", np.array([-1e9, 1e-9])), ("tiny", rng.random(400) * 1e-12), ("huge", 10 ** rng.uniform(-200, 200, 400)),
             ("close", 1 + rng.integers(0, 1000, 2000) * 2.0 ** -50), ("signs", np.array([-0.0, 0.0, -1.0, 1.0] * 50)),
             ("constant", np.full(900, 7.25)), ("negative", -rng.gamma(2.0, 1000.0, 2500))]
    pdf = pd.DataFrame([(g, v) for g, vs in parts for v in vs], columns=["g", "v"]).sample(frac=1, random_state=1)
    check(spark, pdf)


def test_a_hot_group_passes_as_buckets(spark):
    rng = np.random.default_rng(6)
    g = np.where(rng.random(40_000) < 0.9, 0, rng.integers(1, 2000, 40_000))
    check(spark, pd.DataFrame({"g": g, "v": rng.lognormal(5, 2, 40_000).round(3)}), num_partitions=16)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(allow_nan=False, allow_infinity=False, min_value=-1e200, max_value=1e200)),
                min_size=1, max_size=60))
def test_any_values(spark, rows):
    check(spark, pd.DataFrame(rows, columns=["g", "v"]))


def test_infinities_and_nothing(spark):
    df = spark.createDataFrame([(1, float("inf")), (1, 1.0), (1, float("-inf")), (2, float("nan")), (2, None)], "g int, v double")
    assert [(r.g, r.p50) for r in percentiles(df, ["g"], "v", {"p50": 0.5}).collect()] == [(1, 1.0)]
    assert percentiles(df.limit(0), ["g"], "v", PROBS).count() == 0
    assert percentiles(df.where("v = 1"), [], "v", {"m": 0.5}).first().m == 1.0


def test_values_are_neither_sorted_nor_written(spark, monkeypatch):
    plans = []

    def see(df):
        plans.append((df._jdf.queryExecution().executedPlan().toString(), df.count()))

    monkeypatch.setattr(session, "ON_CUT", [see])
    df = spark.range(0, 50_000, numPartitions=8).selectExpr("id % 2 AS g", "pmod(xxhash64(id), 1000003) / 7 AS v")
    out = percentiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75})
    assert out.count() == 2
    plans.append((out._jdf.queryExecution().executedPlan().toString(), 2))
    assert len(plans) >= 2
    for plan, rows in plans:
        assert "rangepartitioning" not in plan and rows <= 2 * 2 * 2


# --- divisions --------------------------------------------------------------

def test_auc_and_metrics_of_a_one_class_tenant(spark):
    rows = [(1, i % 2, i / 10) for i in range(10)] + [(2, 0, i / 10) for i in range(10)] + [(3, 1, 0.9)]
    df = spark.createDataFrame(rows, "firm_id long, is_churn int, churn_prob double")
    got = {r.firm_id: r.auc for r in cm.auc(df, "is_churn", "churn_prob").collect()}
    assert got[2] is None and got[3] is None and 0.5 < got[1] < 0.7
    assert cm.binary_metrics(df, "is_churn", "churn_prob", 0.5).count() == 3


def test_outliers_of_a_column_without_values(spark):
    rows = [(f, 0, f, *[None if (f, c) == (2, "avg_spent") else float(i % 9) for c in cm.ROUND_COLS]) for f in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "firm_id long, program_id int, is_churn int, " + ", ".join(f"{c} double" for c in cm.ROUND_COLS))
    flags = cm.outlier_columns(df).collect()
    assert len(flags) == 2 * len(cm.ROUND_COLS) - 1
    assert not [r for r in flags if r.firm_id == 2 and r.column == "avg_spent"]


def test_a_row_without_a_score_has_no_class(spark):
    df = spark.createDataFrame([(1, None), (2, 0.9), (3, 0.1)], "firm_id long, churn_prob double")
    got = {r.firm_id: (r.is_churn_pred, r.is_churn_label, r.churn_class) for r in cm.postprocess(df).collect()}
    assert got[1] == (None, None, cm.RISK_UNKNOWN)
    assert got[2][:2] == (1, cm.LABEL_CHURN) and got[3][:2] == (0, cm.LABEL_NO_RISK)


# --- joins and lags ---------------------------------------------------------

def test_long_strings_are_not_broadcast(spark, monkeypatch):
    from loyalflow.operators import joins

    monkeypatch.setattr(joins, "MAX_BYTES", 100_000)
    short = spark.range(100).selectExpr("id", "'x' AS s")
    long = spark.range(100).selectExpr("id", "repeat('x', 2000) AS s")
    hinted = [joins.broadcast_checked(df, 1000)._jdf.queryExecution().logical().toString() for df in (short, long)]
    assert "broadcast" in hinted[0] and "broadcast" not in hinted[1]


def test_lag_with_hot_and_other_groups(spark):
    from loyalflow.operators.ranking import lag

    rng = np.random.default_rng(8)
    g = np.where(rng.random(4000) < 0.5, 0, rng.integers(1, 60, 4000))
    pdf = pd.DataFrame({"g": g, "t": rng.permutation(4000), "v": rng.integers(0, 99, 4000)})
    pdf["want"] = pdf.sort_values("t").groupby("g")["v"].shift(1)
    df = spark.createDataFrame(pdf[["g", "t", "v"]]).repartition(6)
    for hot in (100, 10_000):  # the hot group in chunks, and none
        got = lag(df, ["g"], ["t"], "v", "prev", hot_rows=hot).toPandas().merge(pdf, on=["g", "t", "v"])
        assert len(got) == 4000 and np.allclose(got["prev"].astype(float), got["want"], equal_nan=True)
