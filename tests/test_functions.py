"""Edge rows of the column helpers (hand-built frames with known answers)."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loyalflow.functions import dates as D
from loyalflow.functions import stats as S
from loyalflow.functions import text as T
from loyalflow.params import RunParams, add_months


def one(spark, expr, schema="x int", rows=((1,),)):
    return spark.createDataFrame(list(rows), schema).select(expr.alias("r")).collect()


def test_add_months_keeps_time_and_month_end():
    assert add_months(datetime(2001, 8, 1, 12), -24) == datetime(1999, 8, 1, 12)
    assert add_months(datetime(2023, 2, 28, 9), 12) == datetime(2024, 2, 29, 9)  # last day sticks
    assert add_months(datetime(2001, 3, 31, 12), -1) == datetime(2001, 2, 28, 12)
    assert add_months(datetime(2001, 1, 15), 13) == datetime(2002, 2, 15)


def test_profile_key_and_cutoff():
    p = RunParams()
    assert p.profile_key == 19990801
    assert p.churn_cutoff == datetime(2001, 2, 2, 12)


def test_parse_date_key(spark):
    rows = [(20241301,), (1010101,), (None,), (20010801,), (19950229,)]
    df = spark.createDataFrame(rows, "k int").select(D.parse_date_key("k").alias("d"))
    got = [r.d for r in df.collect()]
    assert got == [None, date(101, 1, 1), None, date(2001, 8, 1), None]


def test_iso_weekday(spark):
    df = spark.createDataFrame([(date(2000, 1, 1),), (date(2000, 1, 2),), (date(2000, 1, 3),)], "d date")
    assert [r.w for r in df.select(D.iso_weekday("d").alias("w")).collect()] == [6, 7, 1]


def test_age_band_edges(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 25, 26, 56, None)], "a int")
    assert [r.b for r in df.select(D.age_band("a").alias("b")).collect()] == \
        [None, "18-25", "18-25", "26-35", "56+", None]


def test_completed_years_uses_day_and_time(spark):
    as_of = F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")
    df = spark.createDataFrame([(date(1983, 8, 1),), (date(1983, 8, 2),), (date(1983, 7, 31),)], "b date")
    assert [r.a for r in df.select(D.completed_years(as_of, "b").alias("a")).collect()] == [18, 17, 18]


def test_birthday_fold_feb_29(spark):
    df = spark.createDataFrame([(date(1980, 2, 29),)], "b date")
    r = df.select(D.birthday_this_year("b", F.lit(2001)).alias("d")).first()
    assert r.d == date(2001, 2, 28)


def test_frac_days(spark):
    df = spark.createDataFrame([(datetime(2001, 1, 2, 6), datetime(2001, 1, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(D.frac_days("a", "b").alias("d")).first().d == pytest.approx(1.25)


def test_equal_width_bin_right_closed_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (2.0001,), (10.0,)], "x double")
    got = [r.b for r in df.select(S.equal_width_bin("x", F.lit(0.0), F.lit(10.0), 5).alias("b")).collect()]
    assert got == [1, 1, 2, 5]
    cst = spark.createDataFrame([(3.0,)], "x double")
    assert cst.select(S.equal_width_bin("x", F.lit(3.0), F.lit(3.0), 5).alias("b")).first().b == 3
    assert cst.select(S.equal_width_bin("x", F.lit(3.0), F.lit(3.0), 3).alias("b")).first().b == 2


def test_equal_width_bin_matches_pd_cut(spark):
    import numpy as np
    vals = np.random.default_rng(7).integers(0, 50, 300).astype(float)
    expected = pd.cut(vals, bins=5, labels=False) + 1
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    lo, hi = float(vals.min()), float(vals.max())
    got = [r.b for r in df.select(S.equal_width_bin("x", F.lit(lo), F.lit(hi), 5).alias("b")).collect()]
    assert got == list(expected)


def test_pct_half_up(spark):
    df = spark.createDataFrame([(1, 3), (1, 8), (1, 16), (-1, 16), (0, 5), (3, 0)], "n long, t long")
    got = [r.p for r in df.select(S.pct_half_up("n", "t").alias("p")).collect()]
    assert got == [33.3, 12.5, 6.3, -6.3, 0.0, None]


def test_stddev_single_row_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0)], "g int, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(S.stddev_oracle("x").alias("s")).collect()}
    assert got[1] == 0.0
    assert got[2] == pytest.approx(1.4142135, rel=1e-6)


def test_round_int_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,), (float("nan"),)], "x double")
    assert [r.r for r in df.select(S.round_int_even("x").alias("r")).collect()] == [0, 2, 2, 0, 0]


def test_money_ratio_2dp_half_up(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("56205.23"), 2), (Decimal("-0.30"), 4), (Decimal("10.00"), 3)],
                               "s decimal(18,2), n long")
    got = [r.r for r in df.select(S.money_ratio_2dp("s", "n").alias("r")).collect()]
    assert got == [Decimal("28102.62"), Decimal("-0.08"), Decimal("3.33")]


def test_suffix_and_number_text(spark):
    from loyalflow.operators.insight import num_text
    df = spark.createDataFrame([(40.1,), (50.0,), (100.0,), (0.0,), (12.5,), (9.0,)], "x double")
    t = num_text("x")
    got = [(r.t, r.s) for r in df.select(t.alias("t"), T.tr_suffix(t).alias("s")).collect()]
    assert got == [("40.1", "'i"), ("50", "'si"), ("100", "ü"), ("0", "ü"), ("12.5", "'i"), ("9", "'u")]


def test_month_name(spark):
    df = spark.createDataFrame([(1,), (8,), (12,)], "m int")
    assert [r.n for r in df.select(T.month_name_tr("m").alias("n")).collect()] == ["Ocak", "Ağustos", "Aralık"]
