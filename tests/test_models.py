"""Boosting with patience, per-tenant models, scalers, publishing and partition-wise upserts."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loyalflow.operators import churn_model as cm
from loyalflow.operators import sinks
from loyalflow.operators import tenant_models as tm
from loyalflow.session import scratch_path

SCHEMA = "unique_customer_id long, program_id int, firm_id long, is_churn int, " + ", ".join(f"{c} double" for c in cm.MODEL_FEATURES)


def noisy_rows(n, firms, seed, signal=1.0, one_class=()):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        firm = 1 + i % firms
        y = 0 if firm in one_class else int(rng.random() < 0.5)
        values = {c: float(rng.normal()) for c in cm.MODEL_FEATURES}
        values["customer_lifetime"] += signal * y
        rows.append((i, int(i % 3), firm, y, *[values[c] for c in cm.MODEL_FEATURES]))
    return rows


def prepared(spark, rows):
    return cm.class_weights(cm.stratified_split(spark.createDataFrame(rows, SCHEMA)))


def test_a_noisy_round_does_not_end_the_search():
    losses = [5.0, 4.0, 4.2, 3.0, 3.5, 3.4, 3.3, 3.2]
    assert cm.best_round(losses, 50) == 4
    assert cm.best_round(losses, 1) == 2  # the first rise would have ended it
    assert cm.best_round([1.0], 3) == 1 and cm.best_round([2.0, 2.0, 2.0], 5) == 1
    assert cm.best_round([9, 8, 9, 9, 9, 1], 3) == 2  # too late


def test_the_model_keeps_its_best_round(spark):
    data = prepared(spark, noisy_rows(500, 1, 2, signal=0.7))
    model = cm.fit_churn(data, max_iter=30, patience=8)
    gbt = model.stages[-1]
    whole = cm.build_pipeline(max_iter=30).fit(cm._with_cat_strings(data.where(~F.col("is_val"))))
    held = cm.PipelineModel(whole.stages[:-1]).transform(cm._with_cat_strings(data.where("is_val")))
    losses = whole.stages[-1].evaluateEachIteration(held)
    assert 1 <= len(gbt.trees) <= 30
    # cutting keeps the first rounds as they are
    cut = cm.first_rounds(whole.stages[-1], 5)
    assert len(cut.trees) == 5 and cut.evaluateEachIteration(held) == pytest.approx(losses[:5])
    assert cut.treeWeights == whole.stages[-1].treeWeights[:5] and len(cut.featureImportances) >= 1
    path = scratch_path(spark, "cut")
    cm.PipelineModel([*whole.stages[:-1], cut]).save(path)
    again = cm.churn_probability(cm.PipelineModel.load(path), data)
    assert again.where("churn_prob BETWEEN 0 AND 1").count() == 500


def test_boosting_of_the_scores_goes_on_while_the_loss_falls(spark, sf_small, monkeypatch):
    from types import SimpleNamespace

    from loyalflow.plans import catalog

    tried, kept = [], []

    def build_pipeline(params, rounds, bins):  # a model whose loss falls up to round 730
        tried.append(rounds)
        gbt = SimpleNamespace(evaluateEachIteration=lambda held: [float(abs(i - 729)) for i in range(rounds)])
        return SimpleNamespace(fit=lambda used: SimpleNamespace(stages=[gbt]))

    monkeypatch.setattr(cm, "build_pipeline", build_pipeline)
    monkeypatch.setattr(cm, "first_rounds", lambda gbt, rounds: kept.append(rounds) or gbt)
    data = prepared(spark, noisy_rows(100, 1, 2))
    monkeypatch.setattr(catalog, "_MODELS", {})
    monkeypatch.setattr(catalog.cf, "churn_training_set", lambda *a: data)
    monkeypatch.setattr(cm, "fit_suppression", lambda *a: None)
    monkeypatch.setattr(cm, "prepare_training", lambda *a: data)
    catalog.fitted(spark, sf_small)
    assert tried == [100, 200, 400, 1000] and kept == [730]


def test_tenants_with_one_class_or_a_broken_fit_do_not_end_the_others(spark, monkeypatch):
    data = prepared(spark, noisy_rows(600, 4, 3, one_class=(2,)))
    store = tm.ModelStore(spark, scratch_path(spark, "models"), 7)
    fit = cm.fit_churn

    def broken(df, *args, **kw):
        if df.first().firm_id == 3:
            raise RuntimeError("no luck")
        return fit(df, *args, **kw)

    monkeypatch.setattr(tm, "fit_churn", broken)
    log = {r.firm_id: (r.outcome, r.detail) for r in tm.fit_tenants(data, store, max_iter=3, at_once=2).collect()}
    assert {f: o for f, (o, _) in log.items()} == {1: "fitted", 2: "one class", 3: "failed", 4: "fitted"}
    assert "no luck" in log[3][1] and store.firms() == [1, 4]
    monkeypatch.undo()
    again = {r.firm_id: r.outcome for r in tm.fit_tenants(data, store, max_iter=3).collect()}
    assert again == {1: "kept", 2: "one class", 3: "fitted", 4: "kept"}  # only the missing one
    path = scratch_path(spark, "scores")
    for _ in range(2):  # the same table again
        scored = tm.score_tenants(store, data, path, per_plan=2)
        assert scored.count() == 600
    by = {r.firm_id: r.n for r in scored.groupBy("firm_id").agg(F.count("churn_prob").alias("n")).collect()}
    assert by == {1: 150, 2: 0, 3: 150, 4: 150}
    imp = tm.tenant_importances(store, 7, scratch_path(spark, "imp"))
    assert imp.count() == 3 * len(cm.MODEL_FEATURES + cm.CATEGORICAL)


# --- scalers ----------------------------------------------------------------

def test_scalers_equal_pandas_and_apply_to_unseen_rows(spark):
    from loyalflow.operators import scalers

    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"firm_id": rng.integers(1, 4, 500), "a": rng.lognormal(3, 1, 500).round(2), "b": rng.integers(0, 9, 500) * 1.0,
                        "c": 5.0})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    for kind, want in {
            "minmax": lambda x: (x - x.min()) / ((x.max() - x.min()) or 1.0),
            "standard": lambda x: (x - x.mean()) / (x.std(ddof=0) or 1.0),
            "robust": lambda x: (x - x.median()) / ((x.quantile(0.75) - x.quantile(0.25)) or 1.0)}.items():
        fitted = scalers.fit_scaler(df, ["a", "b", "c"], kind)
        got = scalers.scale(df, fitted, ["a", "b", "c"]).toPandas()
        for c in ("a", "b", "c"):
            assert np.allclose(got[f"{c}_scaled"], got.groupby("firm_id")[c].transform(want), equal_nan=True), (kind, c)
        unseen = spark.createDataFrame([(1, 1e6, 2.0, 5.0), (9, 1.0, 1.0, 1.0)], "firm_id long, a double, b double, c double")
        new = {r.firm_id: r for r in scalers.scale(unseen, fitted, ["a", "b", "c"]).collect()}
        x = pdf[pdf.firm_id == 1]["a"]
        assert new[1].a_scaled == pytest.approx(float((want(pd.concat([x]))).max() / (x.max() - x.min()) * (1e6 - x.min()))) if kind == "minmax" \
            else new[1].a_scaled > 100
        assert new[1].c_scaled == 0.0 and new[9].a_scaled is None  # a firm that was not fitted
    with pytest.raises(ValueError):
        scalers.fit_scaler(df, ["a"], "other")


# --- tables -----------------------------------------------------------------

def files_of(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_leaves_other_partitions_alone(spark):
    path = scratch_path(spark, "customers")
    old = spark.createDataFrame([(f, u, f"old{u}") for f in (1, 2, 3) for u in range(5)], "firm_id long, uid long, v string")
    sinks.write_parquet(old, path)
    before = files_of(path)
    new = spark.createDataFrame([(2, 1, "new1"), (2, 9, "new9"), (4, 1, "first")], "firm_id long, uid long, v string")
    sinks.upsert_partitions(new, path, ["firm_id", "uid"])
    after = files_of(path)
    assert {p: t for p, t in after.items() if "firm_id=1" in p or "firm_id=3" in p} == \
        {p: t for p, t in before.items() if "firm_id=1" in p or "firm_id=3" in p}
    got = {(int(r.firm_id), r.uid): r.v for r in spark.read.parquet(path).collect()}
    want = {(f, u): f"old{u}" for f in (1, 2, 3) for u in range(5)} | {(2, 1): "new1", (2, 9): "new9", (4, 1): "first"}
    assert got == want
    with pytest.raises(ValueError):
        sinks.upsert_partitions(new, path, ["uid"])


def test_a_runs_partition_is_replaced_and_aligned(spark):
    path = scratch_path(spark, "history")
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "firm_id long, name string, v double")
    sinks.replace_run(a, path, 1)
    sinks.replace_run(a.where("firm_id = 1"), path, 1)  # again, with fewer firms
    sinks.replace_run(a.drop("v").withColumn("more", F.lit(1)), path, 2)  # a column less, one too many
    got = sorted((r.run_id, int(r.firm_id), r.name, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1, "x", 1.0), (2, 1, "x", None), (2, 2, "y", None)]
    assert set(spark.read.parquet(path).columns) == {"run_id", "firm_id", "name", "v"}


def test_publishing_switches_whole_versions(spark):
    table, folder = "customers_published", scratch_path(spark, "published")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = [spark.range(0, n).selectExpr("id % 2 AS firm_id", "id AS uid") for n in (4, 7, 9)]
    first = sinks.publish(rows[0], table, folder)
    assert spark.table(table).count() == 4
    sinks.publish(rows[1], table, folder)
    assert spark.table(table).count() == 7
    assert spark.read.parquet(first).count() == 4  # who began to read the old version finds its files

    with pytest.raises(Exception):
        sinks.publish(rows[2].withColumn("uid", F.raise_error(F.lit("half way"))), table, folder)
    assert spark.table(table).count() == 7
    sinks.publish(rows[2], table, folder)
    assert spark.table(table).count() == 9 and len(sinks.listed(spark, folder, "version=")) == 2
    sinks.append_to_table(spark.createDataFrame([(100, "x", 1)], "uid long, extra string, firm_id long"), table)
    assert spark.table(table).where("uid = 100 AND firm_id = 1").count() == 1
    spark.sql(f"DROP TABLE {table}")


def test_a_fit_has_few_partitions_whatever_those_of_its_rows(spark):
    cols = [F.col("id").cast("double").alias(c) for c in cm.MODEL_FEATURES]
    most = cm.FIT_TASKS * spark.sparkContext.defaultParallelism
    rows = spark.range(1000).select(*cols)
    few = rows.repartition(most)
    assert cm.fit_partitions(few) is few
    one, many = (cm.fit_partitions(rows.repartition(most * k)) for k in (2, 3))
    assert one.rdd.getNumPartitions() == many.rdd.getNumPartitions() == most
    assert one.rdd.glom().collect() == many.rdd.glom().collect()
    assert sorted(r[0] for r in many.collect()) == list(range(1000))
