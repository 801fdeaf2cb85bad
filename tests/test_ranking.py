"""Skew-safe ordered operators against pandas, with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loyalflow.operators.ranking import lag_in_order, row_positions
from loyalflow.operators.selection import percentiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 6000
    g = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n))  # key 0 holds ~60% of rows
    pdf = pd.DataFrame({"g": g, "v": rng.normal(size=n).round(1), "t": rng.permutation(n)})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_percentiles_match_pandas_on_hot_key(spark, skewed):
    pdf, df = skewed
    got = percentiles(df, ["g"], "v", {"q25": 0.25, "q50": 0.5, "q80": 0.8}, num_partitions=16) \
        .toPandas().sort_values("g").reset_index(drop=True)
    exp = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.8]).unstack().reset_index()
    assert np.allclose(got[["q25", "q50", "q80"]].values, exp[[0.25, 0.5, 0.8]].values)


def test_percentiles_ignore_nulls_and_single_values(spark):
    df = spark.createDataFrame([(1, None), (1, 4.0), (2, 1.0), (2, 3.0)], "g int, v double")
    got = {r.g: r.m for r in percentiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {1: 4.0, 2: 2.0}


def test_row_positions_are_exact_ranks(spark, skewed):
    pdf, df = skewed
    got = row_positions(df, ["g"], [F.col("t")], num_partitions=16).toPandas()
    exp = pdf.assign(r=pdf.groupby("g")["t"].rank(method="first").astype(int) - 1)
    m = got.merge(exp, on=["g", "t"])
    assert len(m) == len(pdf)
    assert (m["_rank"] == m["r"]).all()
    assert (m["_n"] == m.groupby("g")["t"].transform("count")).all()


def test_lag_matches_pandas_shift(spark, skewed):
    pdf, df = skewed
    got = lag_in_order(df.select("g", "t", "v"), ["g"], ["t"], "v", "prev", num_partitions=16).toPandas()
    exp = pdf.sort_values(["g", "t"]).assign(prev=lambda d: d.groupby("g")["v"].shift(1))
    m = got.merge(exp[["g", "t", "prev"]], on=["g", "t"], suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert np.allclose(m["prev"].fillna(-999).values, m["prev_e"].fillna(-999).values)


def test_ntile_from_rank_matches_sql_ntile(spark):
    from loyalflow.operators.segments import ntile_from_rank
    rows = [(i,) for i in range(13)]
    df = spark.createDataFrame(rows, "r long").withColumn("n", F.lit(13))
    got = [x.b for x in df.select(ntile_from_rank(F.col("r"), F.col("n"), 5).alias("b")).orderBy("r").collect()]
    assert got == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5]


def test_null_group_keys_form_their_own_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 10.0), ("a", 20.0), ("a", 30.0)], "g string, v double")
    got = {r.g: r.m for r in percentiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 20.0}
    lagged = lag_in_order(df, ["g"], ["v"], "v", "prev").collect()
    assert sorted((r.g or "", r.v, r.prev) for r in lagged) == [
        ("", 1.0, None), ("", 3.0, 1.0), ("a", 10.0, None), ("a", 20.0, 10.0), ("a", 30.0, 20.0)]


def test_churn_features_with_a_hot_customer(spark):
    """Gap/median/stddev features when one customer holds most transactions."""
    from datetime import datetime, timedelta
    from decimal import Decimal

    from loyalflow.operators.churn_features import transaction_features

    rng = np.random.default_rng(11)
    rows = []
    tid = 0
    for cust, n in [(0, 3000)] + [(c, int(rng.integers(2, 40))) for c in range(1, 25)]:
        for _ in range(n):
            tid += 1
            ts = datetime(2000, 1, 1) + timedelta(hours=int(rng.integers(0, 20000)))
            amt = Decimal(int(rng.integers(100, 100000))).scaleb(-2)
            rows.append((cust * 2, int(cust % 3) + 1, int(rng.integers(0, 3)), ts, tid, amt,
                         Decimal("0.00"), None, Decimal("1.00")))
    schema = ("unique_customer_id long, firm_id long, program_id int, transaction_date timestamp_ntz, "
              "transaction_id long, amount_after_discount decimal(18,2), amount_discount decimal(18,2), "
              "amount_used_point decimal(18,2), amount_earned_point decimal(18,2)")
    df = spark.createDataFrame(rows, schema)
    got = transaction_features(df).toPandas().set_index(["unique_customer_id", "program_id"]).sort_index()

    pdf = pd.DataFrame(rows, columns=["uid", "firm", "prog", "ts", "tid", "amt", "disc", "used", "earned"])
    pdf = pdf.sort_values(["uid", "ts", "tid", "amt"])
    pdf["prev"] = pdf.groupby("uid")["ts"].shift(1)
    pdf["gap"] = (pdf["ts"] - pdf["prev"]).dt.total_seconds() / 86400.0
    pdf["amt_f"] = pdf["amt"].astype(float)
    exp = pdf.groupby(["uid", "prog"]).agg(gap=("gap", "mean"), med=("amt_f", "median"),
                                           sd=("amt_f", "std"), n=("ts", "count")).sort_index()
    exp["sd"] = exp["sd"].where(exp["n"] > 1, 0.0)
    assert len(got) == len(exp)
    assert np.allclose(got["avg_days_between_transactions"].astype(float).fillna(-1).values,
                       exp["gap"].fillna(-1).values)
    assert np.allclose(got["median_basket_size"].values, exp["med"].values)
    assert np.allclose(got["basket_size_stddev"].values, exp["sd"].values)
    assert (got["distinct_transactions"].values == exp["n"].values).all()


def test_hot_key_is_split_across_chunks(spark):
    from loyalflow.operators.ranking import positions
    n = 40000
    df = spark.range(n).selectExpr("CASE WHEN id % 10 < 9 THEN 0 ELSE id % 97 END AS g", "id AS t")
    out = positions(df, ["g"], [F.col("t")], num_partitions=16, keep_chunk=True)
    chunks = out.where("g = 0").select("_pid").distinct().count()
    assert chunks >= 8  # the hot key (90% of rows) is processed by many tasks
    hot = out.where("g = 0").agg(F.min("_start").alias("lo"), F.max("_start").alias("hi"),
                                 F.max("_n").alias("n")).first()
    size = sum(1 for i in range(n) if i % 10 < 9 or i % 97 == 0)
    assert (hot.lo, hot.hi, hot.n) == (0, size - 1, size)  # ranks stay exact across chunks


def test_medians_of_hot_and_other_customers_take_one_exchange(spark):
    from loyalflow.operators import churn_features as cf

    rng = np.random.default_rng(5)
    rows = [(int(c), 1, None if p == 2 else int(p), i, int(a)) for i, (c, p, a) in enumerate(zip(
        np.where(rng.random(900) < 0.4, 0, rng.integers(1, 40, 900)), rng.integers(0, 3, 900), rng.integers(0, 50, 900)))]
    df = spark.createDataFrame(rows, "u int, f int, p int, i int, a int").selectExpr(
        "CAST(u AS LONG) AS unique_customer_id", "CAST(f AS LONG) AS firm_id", "TIMESTAMP_NTZ'2001-01-01 00:00:00' + make_dt_interval(i % 300) "
        "AS transaction_date", "CAST(i AS LONG) AS transaction_id", "CAST(a AS DECIMAL(18,2)) AS amount_after_discount", "p AS program_id",
        "CAST(0 AS DECIMAL(18,2)) AS amount_discount", "CAST(0 AS DECIMAL(18,2)) AS amount_used_point",
        "CAST(0 AS DECIMAL(18,2)) AS amount_earned_point").repartition(5)
    pdf = pd.DataFrame(rows, columns=["u", "f", "p", "i", "a"]).dropna()
    want = pdf.groupby(["u", "p"])["a"].median()
    for hot in (None, 100):  # no hot customer, and one whose rows are split
        got = cf.features_of(df, hot).toPandas()
        assert got[got["program_id"].isna()]["median_basket_size"].isna().all() and got["program_id"].isna().any()
        known = got.dropna(subset=["program_id"]).set_index(["unique_customer_id", "program_id"])["median_basket_size"].sort_index()
        assert len(known) == len(want) and np.allclose(known.values, want.sort_index().values)
    plan = cf.features_of(df, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
