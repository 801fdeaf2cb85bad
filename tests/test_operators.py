"""Operator-level behaviour on hand-built frames (edge rows) and model quality."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loyalflow.operators import churn_model as cm
from loyalflow.operators import tenant_models as tm
from loyalflow.operators import sinks
from loyalflow.operators.rfm import rfm_aggregate
from loyalflow.operators.segments import recency_segment
from loyalflow.params import RunParams
from loyalflow.session import scratch_path

TRX = ("firm_id long, transaction_id long, customer_id long, program_id int, trx_state_id int, is_deleted int, "
       "transaction_date timestamp_ntz, timed_id_transaction int, transaction_hour int, amount_total decimal(18,2), "
       "amount_after_discount decimal(18,2), amount_discount decimal(18,2), amount_earned_point decimal(18,2), "
       "amount_used_point decimal(18,2)")


def trx_row(tid, cust, state, ts, amount, earned=Decimal("0"), used=None):
    key = ts.year * 10000 + ts.month * 100 + ts.day
    return (1, tid, cust, 0, state, 0, ts, key, ts.hour, amount, amount, Decimal("0"), earned, used)


def test_rfm_edge_rows(spark):
    cust = spark.createDataFrame([(1, 10, 1, 0, 0), (2, 20, 1, 0, 0)],
                                 "customer_id long, unique_customer_id long, firm_id long, program_id int, is_deleted int")
    prog = spark.createDataFrame([(1, 0, "P")], "firm_id long, program_id int, program_name string")
    rows = [
        trx_row(1, 1, 1, datetime(2001, 7, 1, 10), Decimal("100.00"), Decimal("1.00")),
        trx_row(2, 1, 3, datetime(2001, 7, 1, 18), Decimal("-20.00")),  # return same day as last sale
        trx_row(3, 2, 3, datetime(2001, 7, 5, 9), Decimal("-50.00")),   # returns only -> dropped by HAVING
    ]
    trx = spark.createDataFrame(rows, TRX)
    out = {r.unique_customer_id: r for r in rfm_aggregate(trx, cust, prog, RunParams()).collect()}
    assert set(out) == {10}
    r = out[10]
    assert r.son_islem_iade == 1 and r.frequency == 2 and r.frequency_iade == 1
    assert r.monetary == Decimal("80.00") and r.iade_ciro_orani == pytest.approx(0.2)
    assert r.recency == 31 and r.kazanilan_harcanan_tutar_oran == 0.0


def test_recency_segment_priority(spark):
    p = RunParams()
    rows = [("2001-07-30", "2001-07-20"), ("2001-04-01", "2000-01-01"), ("2001-06-01", "2000-01-01"),
            ("2000-01-01", "1999-01-01")]
    df = spark.createDataFrame(rows, "l string, f string").select(
        F.to_date("l").alias("son_alv_dt"), F.to_date("f").alias("ilk_odeme_dt"))
    got = [r.s for r in df.select(recency_segment(p).alias("s")).collect()]
    assert got == ["New Customer", "Active - at risk", "Active Customer", "Passive Customer"]


def test_risk_class_edges(spark):
    df = spark.createDataFrame([(0.6,), (0.95,), (None,), (0.1,)], "p double")
    got = [r.c for r in df.select(cm.risk_class("p").alias("c")).collect()]
    assert got == ["medium", "high", "unknown", "low"]


def test_outlier_detection_constant_column_not_flagged(spark):
    rows = [(1, 0, 0, float(i % 3), 5.0) for i in range(100)] + [(1, 0, 0, 1000.0, 5.0)] * 3
    df = spark.createDataFrame(rows, "firm_id long, program_id int, is_churn int, a double, b double")
    got = {r.column: r.flagged for r in cm.outlier_columns(df, cols=["a", "b"]).collect()}
    assert got == {"a": True, "b": False}


def test_winsorize_negative_sqrt_becomes_null_then_zero(spark):
    rows = [(1, 0, 0, float(v)) for v in [1, 2, 3, 4, 5] * 20] + [(1, 0, 0, 1e6)] * 3 + [(1, 0, 0, -4.0)]
    df = spark.createDataFrame(rows, "firm_id long, program_id int, is_churn int, a double")
    flags = cm.outlier_columns(df, cols=["a"])
    w = cm.round_features(cm.winsorize(df, flags, cols=["a"]), cols=["a"])
    vals = sorted(r.a for r in w.collect())
    assert vals[0] == 0  # sqrt(-4) -> NULL -> 0
    assert max(vals) < 1000  # capped at mean + 3 std of the sqrt


def test_upsert_prefers_new_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k long, v string")
    got = {r.k: r.v for r in sinks.upsert(old, new, ["k"]).collect()}
    assert got == {1: "a", 2: None, 3: "c"}


def test_rebuild_and_aligned_append(spark):
    path = scratch_path(spark, "t_sink")
    df = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "firm_id long, v long, s string")
    sinks.write_parquet(df, path)
    sinks.rebuild_tenants(spark.createDataFrame([(1, 5, "z"), (1, 6, "w")], "firm_id long, v long, s string"), path)
    back = spark.read.parquet(path)
    assert sorted((r.firm_id, r.v) for r in back.collect()) == [(1, 5), (1, 6), (2, 1)]
    path2 = scratch_path(spark, "t_append")
    spark.createDataFrame([], "v long, s string").write.parquet(path2)
    sinks.append_aligned(spark.createDataFrame([(7, "q", 1.0)], "v long, s string, extra double"), path2)
    sinks.append_aligned(spark.createDataFrame([(8,)], "v long"), path2)
    assert sorted((r.v, r.s) for r in spark.read.parquet(path2).collect()) == [(7, "q"), (8, None)]


def test_status_domain_check_fails_job(spark):
    df = spark.createDataFrame([("DONE",)], "status string")
    with pytest.raises(Exception):
        sinks.validate_status(df).collect()


def test_auc_and_metrics_on_known_scores(spark):
    rows = [(1, 1, 0.9), (1, 1, 0.8), (1, 0, 0.8), (1, 0, 0.1)]
    df = spark.createDataFrame(rows, "firm_id long, y int, p double")
    a = cm.auc(df, "y", "p").first().auc
    assert a == pytest.approx(0.875)
    m = cm.binary_metrics(df, "y", "p", 0.5).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 0, 1)


def test_gbt_learns_planted_signal(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    n = 600
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.5)
        base = {c: float(rng.normal()) for c in cm.MODEL_FEATURES}
        base["customer_lifetime"] += 3.0 * y
        rows.append((i, int(i % 3), 1, y, *[base[c] for c in cm.MODEL_FEATURES]))
    schema = "unique_customer_id long, program_id int, firm_id long, is_churn int, " + \
        ", ".join(f"{c} double" for c in cm.MODEL_FEATURES)
    df = spark.createDataFrame(rows, schema)
    prepared = cm.class_weights(cm.stratified_split(df))
    model = cm.fit_churn(prepared, max_iter=20)
    scored = cm.churn_probability(model, prepared.where("is_val"))
    assert cm.auc(scored, "is_churn", "churn_prob").first().auc > 0.8


def test_truncate_keeps_schema(spark):
    path = scratch_path(spark, "t_trunc")
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    df.write.parquet(path)
    sinks.truncate(spark, path, df.schema)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.columns == ["k", "v"]


def test_tenants_without_tasks(spark):
    from loyalflow.sources import registry as reg
    cust = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "customer_id long, firm_id long")
    tenants = reg.tenants(cust)
    tasks = spark.createDataFrame([(1, 1), (3, 4)], "firm_id long, metric_id int")
    assert [r.ID for r in reg.tenants_without_tasks(tenants, tasks).collect()] == [2]
    assert sorted(r.FIRM_NAME for r in tenants.collect()) == ["FIRM_1", "FIRM_2", "FIRM_3"]


def test_localize_labels(spark):
    from loyalflow.operators.segments import localize
    df = spark.createDataFrame([("VIP Customer",), ("New Customer",), ("unmapped",)], "s string")
    got = [r.t for r in df.select(localize("s").alias("t")).collect()]
    assert got == ["VIP Müşteri", "markayla yeni temas eden", "unmapped"]


def test_analytic_customer_turkish_labels(spark, sf_small):
    from loyalflow.plans import customer as cp
    from loyalflow.sources.staging import staged_domain
    from loyalflow.operators.segments import TURKISH_LABELS
    rows = cp.segmented_rows(staged_domain(spark, sf_small))
    tr = cp.analytic_customer(rows, language="tr")
    labels = {r.P15 for r in tr.select("P15").distinct().collect()} | \
        {r.P6 for r in tr.select("P6").distinct().collect()}
    assert labels and labels <= set(TURKISH_LABELS.values())


def test_read_table_parquet_and_catalog(spark):
    from loyalflow.sources.domain import read_table
    path = scratch_path(spark, "t_read")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").write.parquet(path)
    assert read_table(spark, "ignored", fmt="parquet", path=path).count() == 2
    spark.read.parquet(path).createOrReplaceTempView("t_read_view")
    assert read_table(spark, "t_read_view", fmt="table").count() == 2


def test_cluster_conf_sizes_partitions():
    from loyalflow.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4, total_cores=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts >= 16000 and parts * (256 << 20) >= 100 * 1024 ** 4
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_per_firm_models(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.5)
        base = {c: float(rng.normal()) for c in cm.MODEL_FEATURES}
        base["customer_lifetime"] += 3.0 * y
        rows.append((i, int(i % 3), 1 + i % 2, y, *[base[c] for c in cm.MODEL_FEATURES]))
    schema = "unique_customer_id long, program_id int, firm_id long, is_churn int, " + \
        ", ".join(f"{c} double" for c in cm.MODEL_FEATURES)
    prepared = cm.class_weights(cm.stratified_split(spark.createDataFrame(rows, schema)))
    store = tm.ModelStore(spark, scratch_path(spark, "models"), 1)
    assert {r.outcome for r in tm.fit_tenants(prepared, store, max_iter=10).collect()} == {"fitted"}
    assert store.firms() == [1, 2]
    scored = tm.score_tenants(store, prepared.where("is_val"), scratch_path(spark, "scores"))
    assert scored.count() == prepared.where("is_val").count()
    assert cm.auc(scored, "is_churn", "churn_prob").where("auc > 0.75").count() == 2


def test_many_tenants_and_programs_fit_and_no_row_is_lost(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 70), 1 + i % 70, int(i % 3 == 0), *[float(x) for x in rng.normal(size=len(cm.MODEL_FEATURES))])
            for i in range(1400)]
    schema = "unique_customer_id long, program_id int, firm_id long, is_churn int, " + \
        ", ".join(f"{c} double" for c in cm.MODEL_FEATURES)
    prepared = cm.class_weights(cm.stratified_split(spark.createDataFrame(rows, schema)))
    assert prepared.count() == 1400
    model = cm.fit_churn(prepared, max_iter=2)
    assert cm.churn_probability(model, prepared).where("churn_prob between 0 and 1").count() == 1400
    store = tm.ModelStore(spark, scratch_path(spark, "models"), 1)
    store.save(1, model)
    part = tm.score_tenants(store, prepared, scratch_path(spark, "scores"))
    assert part.count() == 1400
    assert part.where("churn_prob is null").select("firm_id").distinct().count() == 69


def test_capped_sample_is_per_tenant(spark):
    from loyalflow.operators.churn_features import capped_sample

    rows = [(i, 1, 1 if i < 900 else 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "unique_customer_id long, program_id int, firm_id long")
    out = {r.firm_id: r["count"] for r in capped_sample(df, 120).groupBy("firm_id").count().collect()}
    assert out == {1: 120, 2: 100}


def test_rfm_keeps_tenants_with_the_same_ids_apart(spark):
    schema = "customer_id long, unique_customer_id long, firm_id long, program_id int, is_deleted int"
    cust = spark.createDataFrame([(1, 10, 1, 0, 0), (1, 10, 2, 0, 0)], schema)
    prog = spark.createDataFrame([(1, 0, "P"), (2, 0, "Q")], "firm_id long, program_id int, program_name string")
    trx = spark.createDataFrame([trx_row(1, 1, 1, datetime(2001, 7, 1, 10), Decimal("100.00"))], TRX)
    got = [(r.firm_id, r.unique_customer_id, r.kart_tip_detay, r.frequency)
           for r in rfm_aggregate(trx, cust, prog, RunParams()).collect()]
    assert got == [(1, 10, "P", 1)]


def test_suppression_of_unseen_groups_and_own_measures(spark):
    rows = [(i, 0, 1, 0, *[float(i % 5 + 1)] * len(cm.ROUND_COLS)) for i in range(100)]
    rows += [(1000, 0, 1, 1, *[1e6] * len(cm.ROUND_COLS))] * 3
    schema = "unique_customer_id long, program_id int, firm_id long, is_churn int, " + \
        ", ".join(f"{c} double" for c in cm.ROUND_COLS)
    train = spark.createDataFrame(rows, schema)
    stats = cm.fit_suppression(train)
    pred = spark.createDataFrame([(1, 0, 1, 0, *[1e6] * len(cm.ROUND_COLS)), (2, 0, 2, 0, *[1e6] * len(cm.ROUND_COLS))], schema)
    inputs = {r.unique_customer_id: r.total_spent for r in cm.model_inputs(pred, stats).collect()}
    assert inputs[1] < 1000 and inputs[2] == 1_000_000  # firm 2 was not seen in training
    own = cm.shown_values(cm.model_inputs(pred, stats))
    assert {r.total_spent for r in own.collect()} == {1_000_000}


def test_mean_gap_is_exact(spark):
    from loyalflow.functions.dates import avg_frac_days
    df = spark.createDataFrame([(datetime(2001, 1, 1), datetime(2001, 1, 2)), (datetime(2001, 1, 1), datetime(2001, 1, 3)),
                                (None, datetime(2001, 1, 3))], "a timestamp_ntz, b timestamp_ntz")
    assert df.agg(avg_frac_days("b", "a").alias("m")).first().m == 1.5
    assert df.where("a is null").agg(avg_frac_days("b", "a").alias("m")).first().m is None
