"""Churn features and the profile take the transactions into one exchange by customer: nothing is written before
it or dealt out again per transaction; large customers apart give the same rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loyalflow.operators import churn_features as cf
from loyalflow.operators import profile as prof
from loyalflow.operators.ranking import rows_per_group
from loyalflow.params import DEFAULT as P


@pytest.fixture(scope="module")
def tables(spark):
    day = P.as_of - dt.timedelta(days=200)
    rows = [(1 + i % 2, i // 2, i % 7, i % 3, 3 if i % 11 == 0 else 1, 0, day + dt.timedelta(hours=31 * (i % 97)),
             Decimal(i % 13 - 1), Decimal(i % 13 - 1 if i % 4 else i % 13 - 2)) for i in range(600)]
    trx = spark.createDataFrame(rows, "firm_id long, transaction_id long, customer_id long, program_id int, trx_state_id int, is_deleted int, "
                                      "transaction_date timestamp_ntz, amount_total decimal(18,2), amount_after_discount decimal(18,2)")
    d = F.col("transaction_date")
    trx = trx.select("*", F.date_format(d, "yyyyMMdd").cast("int").alias("timed_id_transaction"), F.hour(d).alias("transaction_hour"),
                     (F.col("amount_total") - F.col("amount_after_discount")).cast("decimal(18,2)").alias("amount_discount"),
                     F.lit(1).cast("decimal(18,2)").alias("amount_used_point"), F.lit(2).cast("decimal(18,2)").alias("amount_earned_point"))
    ids = [(f, c, c - c % 2 if c < 6 else None, 0, 0) for f in (1, 2) for c in range(7)]
    cust = spark.createDataFrame(ids, "firm_id long, customer_id long, unique_customer_id long, program_id int, is_deleted int")
    best = spark.createDataFrame([(f, c, "1", "a", dt.date(1980, 2, 29), "F", "S", "x", "y", "z") for f in (1, 2) for c in (0, 2, 4)],
                                 "firm_id long, unique_customer_id long, mobile_number string, email string, birth_date date, gender string, "
                                 "marital_status string, occupation string, education string, real_legal_desc string")
    prog = spark.createDataFrame([(f, p, f"p{p}") for f in (1, 2) for p in range(3)], "firm_id long, program_id int, program_name string")
    return trx, cust, best, prog


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_features_of_counted_customers_are_not_written(spark, tables, monkeypatch):
    trx, cust, _, prog = tables
    names = []
    real = cf.written
    monkeypatch.setattr(cf, "written", lambda df, name: names.append(name) or real(df, name))
    assert _rows(cf.churn_prediction_set(trx, cust, prog, P)) and names == []


def test_large_counted_customers_have_the_same_features(spark, tables):
    trx, cust, *_ = tables
    x = cf.feature_transactions(trx, cust, P, "predict").select(*cf.LAG_COLS)
    counted = rows_per_group(cf.priced_transactions(trx, P, "predict"), cf.live_customers(cust), ["firm_id", "customer_id"], cf.CUSTOMER)
    sizes = {tuple(r)[:2]: r["n"] for r in x.groupBy(*cf.CUSTOMER).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {tuple(r)[:2]: r["n"] for r in counted.groupBy(*cf.CUSTOMER).agg(F.sum("_rows").alias("n")).collect()}
    assert _rows(cf.with_median(x, cf._feature_aggs(), 60, counted)) == _rows(cf.with_median(x, cf._feature_aggs(), None))


def test_profile_has_no_exchange_per_transaction(spark, tables):
    trx, cust, best, prog = tables
    got = prof.purchase_profile(trx, cust, best, prog, P)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "transaction_id" in x]
    apart = prof.purchase_profile(trx, cust, best, prog, P, hot_rows=60)
    assert len(_rows(got)) == 6 and _rows(got) == _rows(apart)


def test_a_condition_counts_once_per_transaction(spark, tables):
    trx, cust, best, prog = tables
    sale = F.col("trx_state_id") == 1
    want = (trx.join(cust.drop("program_id", "is_deleted"), ["firm_id", "customer_id"]).where("unique_customer_id IS NOT NULL")
            .groupBy("firm_id", "unique_customer_id").agg(
        F.count_distinct(F.when(sale & (F.col("amount_after_discount") != F.col("amount_total")), F.col("transaction_id"))),
        F.count_distinct(F.when(sale & (F.col("transaction_hour") < 8), F.col("transaction_id")))))
    got = prof.purchase_profile(trx.unionByName(trx), cust, best, prog, P)
    assert _rows(got.select("firm_id", "unique_customer_id", "indirimli_alv_sayisi", "gece_alv")) == _rows(want)
