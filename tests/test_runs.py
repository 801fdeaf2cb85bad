"""End-to-end run writes every output table for every tenant."""

from pyspark.sql import functions as F

from loyalflow.plans.runs import run_tasks
from loyalflow.session import scratch_path
from loyalflow.sources.staging import staged_domain

TABLES = ["RFM_STG", "ANALYTICAL_PROFILE", "ANALYTIC_ALL_DATA", "ANALYTIC_CUSTOMER_BASE", "ANALYTIC_CUSTOMER",
          "CHURN_PERFORMANCE_METRICS", "CHURN_FEATURE_IMPORTANCES", "CHURN_FIRM_BASED", "ANALYTIC_FIRM_BASED",
          "STG_LOGS"]


def test_run_tasks_writes_all_tables(spark, sf_small):
    out = scratch_path(spark, "run")
    paths = run_tasks(spark, staged_domain(spark, sf_small), out, max_iter=5)
    assert set(TABLES) <= set(paths)
    for t in TABLES:
        assert spark.read.parquet(paths[t]).count() > 0, t
    ac = spark.read.parquet(paths["ANALYTIC_CUSTOMER"])
    ac = spark.createDataFrame(ac.collect(), ac.schema)
    assert ac.count() == ac.select("firm_id", "unique_customer_id").distinct().count()
    assert {"P1", "P15", "P13", "P26"} <= set(ac.columns)
    firm = spark.read.parquet(paths["ANALYTIC_FIRM_BASED"])
    assert firm.where(F.col("P17").isNull()).count() == 0  # narrative present for every firm
    log = spark.read.parquet(paths["STG_LOGS"])
    log = spark.createDataFrame(log.collect(), log.schema)
    assert {r.status for r in log.collect()} == {"PENDING", "SUCCESS"}
    # doing the run again adds to the log and replaces its rows in every other table
    again = run_tasks(spark, staged_domain(spark, sf_small), out, max_iter=5)
    n = {t: spark.read.parquet(again[t]).count() for t in TABLES}
    assert n["STG_LOGS"] == 2 * len(log.collect()) and n["ANALYTIC_CUSTOMER"] == ac.count()
    assert n["CHURN_PERFORMANCE_METRICS"] == 3
    imp = spark.read.parquet(again["CHURN_FEATURE_IMPORTANCES"])
    assert {"firm_id", "created_by", "create_date", "model_id", "feature", "importance"} <= set(imp.columns)


def test_firm_kpis_of_the_run_equal_the_query(spark, sf_small):
    import __spark_entry__ as E

    paths = run_tasks(spark, staged_domain(spark, sf_small), scratch_path(spark, "run_k"), max_iter=2)
    want = E.queries()["firm_p_codes"](spark, sf_small)
    got = spark.read.parquet(paths["ANALYTIC_FIRM_BASED"])
    cols = [c for c in want.columns if c.startswith("P") or c == "firm_id"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_run_tasks_per_firm_models(spark, sf_small):
    out = scratch_path(spark, "run_pf")
    paths = run_tasks(spark, staged_domain(spark, sf_small), out, max_iter=3, per_firm_models=True)
    imp = spark.read.parquet(paths["CHURN_FEATURE_IMPORTANCES"])
    assert imp.select("firm_id").distinct().count() == 3
    assert spark.read.parquet(paths["ANALYTIC_CUSTOMER"]).where(F.col("P22").isNotNull()).count() > 0


def test_task_table_gates_modules_and_a_failure_leaves_the_others(spark, sf_small, monkeypatch):
    from loyalflow.plans import runs
    from loyalflow.sources import registry as reg

    def broken(*args, **kw):
        raise RuntimeError("no model today")

    monkeypatch.setattr(runs, "churn", broken)
    tasks = spark.createDataFrame([(1, reg.RFM_CLV, "RFM_CLV", 1), (1, reg.CHURN, "CHURN", 90), (2, reg.CHURN, "CHURN", 180),
                                   (1, reg.SMART_INSIGHT, "SMART_INSIGHT", 7)],
                                  "firm_id long, metric_id int, display_name string, working_day_period int")
    paths = run_tasks(spark, staged_domain(spark, sf_small), scratch_path(spark, "run_g"), tasks=tasks)
    assert {r.firm_id for r in spark.read.parquet(paths["RFM_STG"]).select("firm_id").distinct().collect()} == {1}
    assert spark.read.parquet(paths["ANALYTIC_FIRM_BASED"]).count() == 1
    log = spark.read.parquet(paths["STG_LOGS"]).collect()
    ended = {(r.firm_id, r.metric_id): r.status for r in log if r.status != "PENDING"}
    assert ended == {(1, 1): "SUCCESS", (1, 4): "FAIL", (2, 4): "FAIL", (1, 3): "SUCCESS"}
    assert all("no model today" in r.detail for r in log if r.status == "FAIL")


def test_a_run_that_broke_off_is_resumed_without_doubled_rows(spark, sf_small, monkeypatch):
    from loyalflow.plans import runs
    from loyalflow.sources import registry as reg

    out, d = scratch_path(spark, "run_r"), staged_domain(spark, sf_small)
    tasks = reg.task_matrix(d.trx, d.cust)
    done = []
    segmentation, of_run = runs.segmentation, runs._of_run
    monkeypatch.setattr(runs, "segmentation", lambda *a: done.append("RFM_CLV") or segmentation(*a))

    def stops(df, out_dir, table, params):
        if table == "CHURN_FEATURE_IMPORTANCES":
            raise RuntimeError("the run ends here")  # after CHURN_PERFORMANCE_METRICS is written
        return of_run(df, out_dir, table, params)

    monkeypatch.setattr(runs, "_of_run", stops)
    run_tasks(spark, d, out, max_iter=2, tasks=tasks)
    monkeypatch.setattr(runs, "_of_run", of_run)
    paths = run_tasks(spark, d, out, max_iter=2, tasks=tasks, resume=True)
    assert done == ["RFM_CLV"]  # segmentation was not done again
    assert spark.read.parquet(paths["CHURN_PERFORMANCE_METRICS"]).count() == 3
    left = runs.succeeded(spark, out, runs.DEFAULT)
    assert left.count() == tasks.count()
    ac = spark.read.parquet(paths["ANALYTIC_CUSTOMER"])
    assert ac.where(F.col("P22").isNotNull()).count() > 0 and ac.where(F.col("P1").isNotNull()).count() > 0
    # another run id has rows of its own, and aligned columns
    other = run_tasks(spark, d, out, runs.DEFAULT.with_(run_id=2), max_iter=2, tasks=tasks.where(F.col("metric_id") == reg.CHURN))
    got = spark.read.parquet(other["CHURN_PERFORMANCE_METRICS"]).groupBy("run_id").count().collect()
    assert {(r.run_id, r["count"]) for r in got} == {(1, 3), (2, 3)}


def test_a_failed_customer_table_is_logged_and_insight_runs(spark, sf_small, monkeypatch):
    from loyalflow.plans import runs
    from loyalflow.sources import registry as reg

    def full(*args):
        raise OSError("no space")

    monkeypatch.setattr(runs, "write_customers", full)
    d = staged_domain(spark, sf_small)
    out = scratch_path(spark, "run_f")
    paths = run_tasks(spark, d, out, tasks=reg.task_matrix(d.trx, d.cust).where(F.col("metric_id") != reg.CHURN))
    log = spark.read.parquet(paths["STG_LOGS"]).collect()
    assert {r.detail for r in log if r.status == "FAIL"} == {"OSError: no space"}
    assert spark.read.parquet(paths["ANALYTIC_FIRM_BASED"]).count() == 3
    ended = {r.metric_id for r in runs.succeeded(spark, out, runs.DEFAULT).select("metric_id").distinct().collect()}
    assert ended == {reg.SMART_INSIGHT}


def test_a_tenant_of_one_class_does_not_end_the_churn_module(spark, sf_small):
    from loyalflow.plans import runs
    from loyalflow.sources import registry as reg
    from loyalflow.sources.domain import Domain

    d = staged_domain(spark, sf_small)
    # firm 3 has no transaction after the cut-off: all its customers have churned
    kept = (F.col("firm_id") != 3) | (F.col("transaction_date") < runs.DEFAULT.churn_cutoff)
    d = Domain(trx=d.trx.where(kept), cust=d.cust, best=d.best, prog=d.prog)
    tasks = spark.createDataFrame([(f, reg.CHURN, "CHURN", 180) for f in (1, 2, 3)],
                                  "firm_id long, metric_id int, display_name string, working_day_period int")
    out = scratch_path(spark, "run_o")
    paths = run_tasks(spark, d, out, max_iter=2, tasks=tasks, per_firm_models=True)
    assert runs.succeeded(spark, out, runs.DEFAULT).count() == 3
    assert spark.read.parquet(paths["CHURN_PERFORMANCE_METRICS"]).where("auc IS NOT NULL").count() == 2
    assert {(int(r.firm_id), r.outcome) for r in spark.read.parquet(paths["CHURN_MODEL_FITS"]).collect()} == {
        (1, "fitted"), (2, "fitted"), (3, "one class")}
    unscored = spark.read.parquet(paths["ANALYTIC_CUSTOMER"]).where("firm_id = 3 AND P22 IS NULL AND P23 IS NULL")
    assert unscored.where(F.col("P24") == "unknown").count() > 0
