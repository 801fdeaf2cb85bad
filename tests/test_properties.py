"""Property tests (Hypothesis): exact helpers and the distributed percentile against
plain-Python / numpy / pandas references on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loyalflow.functions import stats as S
from loyalflow.operators.selection import percentiles

SETTINGS = settings(max_examples=8, deadline=None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10_000, 10_000), st.integers(1, 10_000)), min_size=1, max_size=60),
       st.sampled_from([0, 1, 2]))
def test_pct_half_up_matches_decimal(spark, pairs, decimals):
    df = spark.createDataFrame(pairs, "n long, t long")
    got = [r.p for r in df.select(S.pct_half_up("n", "t", decimals).alias("p")).collect()]
    q = Decimal(1).scaleb(-decimals)
    exp = [float((Decimal(100 * n) / Decimal(t)).quantize(q, rounding=ROUND_HALF_UP)) for n, t in pairs]
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 500)), min_size=1, max_size=60))
def test_money_ratio_matches_decimal(spark, pairs):
    rows = [(Decimal(c).scaleb(-2), n) for c, n in pairs]
    df = spark.createDataFrame(rows, "s decimal(18,2), n long")
    got = [r.r for r in df.select(S.money_ratio_2dp("s", "n").alias("r")).collect()]
    exp = [(s / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for s, n in rows]
    assert got == exp


@SETTINGS
@given(st.lists(st.integers(0, 200), min_size=2, max_size=80), st.sampled_from([3, 5]))
def test_equal_width_bin_matches_pd_cut(spark, values, bins):
    vals = [float(v) for v in values]
    lo, hi = min(vals), max(vals)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.b for r in df.select(S.equal_width_bin("x", F.lit(lo), F.lit(hi), bins).alias("b")).collect()]
    exp = list(pd.cut(np.array(vals), bins=bins, labels=False) + 1)
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=120),
       st.sampled_from([0.25, 0.5, 0.8]))
def test_percentiles_match_pandas(spark, rows, q):
    pdf = pd.DataFrame(rows, columns=["g", "v"]).astype({"v": float})
    df = spark.createDataFrame(pdf)
    got = {r.g: r.p for r in percentiles(df, ["g"], "v", {"p": q}, num_partitions=4).collect()}
    exp = pdf.groupby("g")["v"].quantile(q).to_dict()
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 10_000), st.integers(-100, 100)),
                min_size=1, max_size=150, unique_by=lambda r: (r[0], r[1])),
       st.sampled_from([2, 5, 16]))
def test_lag_matches_pandas_shift(spark, rows, parts):
    from loyalflow.operators.ranking import lag_in_order
    pdf = pd.DataFrame(rows, columns=["g", "t", "v"])
    df = spark.createDataFrame(pdf)
    got = lag_in_order(df, ["g"], ["t"], "v", "prev", num_partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "t"]).assign(prev=lambda d: d.groupby("g")["v"].shift(1))
    m = got.merge(exp, on=["g", "t"], suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert (m["prev"].fillna(-10**6) == m["prev_e"].fillna(-10**6)).all()
