"""End-to-end run: every module for every tenant, written as tables.

The reference loops over tenants and modules on the driver; here all tenants
run in one pass (``firm_id`` is part of every key). Tables are rebuilt whole or, where
they keep a history (models' metrics, importances and summaries), hold a partition
per run, so that a run that is done again replaces its own rows. The log is appended to.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import churn_features as cf
from ..operators import churn_model as cm
from ..operators import insight as ins
from ..operators import profile as prof
from ..operators import rfm as rfm_ops
from ..operators import segments as seg
from ..operators import sinks
from ..operators import tenant_models as tm
from ..operators.joins import broadcast_checked
from ..params import DEFAULT, RunParams
from ..session import cut_lineage
from ..sources import registry as reg
from ..sources.domain import Domain
from . import customer as cust_plan


def _write(df: DataFrame, out_dir: str, table: str, partition_by=("firm_id",)) -> str:
    path = os.path.join(out_dir, table)
    sinks.rebuild_all(df, path, partition_by)
    return path


def _of_run(df: DataFrame, out_dir: str, table: str, params: RunParams) -> str:
    """The rows of this run, next to those of other runs."""
    path = os.path.join(out_dir, table)
    sinks.replace_run(df, path, params.run_id)
    return path


def _part(df: DataFrame, out_dir: str, name: str, params: RunParams) -> DataFrame:
    """A module's part of ANALYTIC_CUSTOMER, written and read back."""
    path = os.path.join(out_dir, "_parts", name)
    sinks.replace_run(df, path, params.run_id)
    return _read_part(df.sparkSession, out_dir, name, params).select(*df.columns)


def _read_part(spark: SparkSession, out_dir: str, name: str, params: RunParams) -> DataFrame:
    part = spark.read.parquet(os.path.join(out_dir, "_parts", name, f"run_id={params.run_id}"))
    return part.withColumn("firm_id", F.col("firm_id").cast("long"))


def churn_performance(scored_val: DataFrame, params: RunParams, model_id: int) -> DataFrame:
    """CHURN_PERFORMANCE_METRICS per firm from the validation rows (threshold 0.5)."""
    m = cm.binary_metrics(scored_val, "is_churn", "churn_prob", params.validation_threshold)
    a = cm.auc(scored_val, "is_churn", "churn_prob")
    return sinks.with_audit(m.join(a, "firm_id", "left"), params.created_by, params.audit_ts_col, model_id)


def _only(d: Domain, firms: DataFrame) -> Domain:
    """The domain tables of some tenants (a row each)."""
    f = broadcast_checked(firms.select("firm_id").distinct(), cm.FIRM_ROWS)
    return Domain(*[x.join(f, "firm_id", "left_semi") for x in (d.trx, d.cust, d.best, d.prog)])


def _log(tasks: DataFrame, status: str, out_dir: str, params: RunParams, started: datetime,
         finished: datetime | None = None, detail: str | None = None) -> str:
    """A run-log event per task."""
    def at(t: datetime | None):
        return F.lit(t and t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    path = os.path.join(out_dir, "STG_LOGS")
    events = sinks.validate_status(tasks.select(
        "firm_id", "metric_id", F.col("display_name").alias("job_type"), F.lit(status).alias("status"),
        at(started).alias("execution_start"), at(finished).alias("execution_end"), at(datetime.now()).alias("logged_at"),
        F.lit(detail).cast("string").alias("detail"), params.audit_ts_col.alias("ett_date"),
        F.lit(params.run_id).cast("long").alias("run_id")))
    events.write.mode("append").partitionBy("run_id", "firm_id").parquet(path)
    return path


def succeeded(spark: SparkSession, out_dir: str, params: RunParams) -> DataFrame:
    """(firm_id, metric_id) of the tasks whose latest event in this run is SUCCESS."""
    path = os.path.join(out_dir, "STG_LOGS")
    if not sinks.path_exists(spark, path):
        return spark.createDataFrame([], "firm_id long, metric_id int")
    log = spark.read.parquet(path).where(F.col("run_id") == params.run_id)
    # an event that tells an end outranks the PENDING of the same moment
    order = F.struct("logged_at", (F.col("status") != "PENDING"), (F.col("status") == "FAIL"))
    last = log.groupBy("firm_id", "metric_id").agg(F.max_by("status", order).alias("status")).where("status = 'SUCCESS'")
    return last.select(F.col("firm_id").cast("long").alias("firm_id"), F.col("metric_id").cast("int").alias("metric_id"))


def segmentation(spark: SparkSession, d: Domain, out_dir: str, params: RunParams, paths: dict[str, str]) -> DataFrame:
    """RFM_CLV: staging tables, segments; returns the segment part of ANALYTIC_CUSTOMER."""
    rfm = rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, params)
    profile = prof.purchase_profile(d.trx, d.cust, d.best, d.prog, params)
    paths["RFM_STG"] = _write(rfm, out_dir, "RFM_STG")
    paths["ANALYTICAL_PROFILE"] = _write(profile, out_dir, "ANALYTICAL_PROFILE")
    all_data = prof.all_data(spark.read.schema(rfm.schema).parquet(paths["RFM_STG"]),
                             spark.read.schema(profile.schema).parquet(paths["ANALYTICAL_PROFILE"]))
    paths["ANALYTIC_ALL_DATA"] = _write(all_data, out_dir, "ANALYTIC_ALL_DATA")
    base = rfm_ops.customer_base(d.trx, params).join(d.cust.select("firm_id", "customer_id"), ["firm_id", "customer_id"])
    paths["ANALYTIC_CUSTOMER_BASE"] = _write(
        sinks.with_audit(base, params.created_by, params.audit_ts_col), out_dir, "ANALYTIC_CUSTOMER_BASE")
    rows = seg.segment_customers(spark.read.schema(all_data.schema).parquet(paths["ANALYTIC_ALL_DATA"]), params)
    return _part(cust_plan.analytic_customer(rows, params), out_dir, "RFM_CLV", params)


def churn(spark: SparkSession, d: Domain, out_dir: str, params: RunParams, paths: dict[str, str],
          thresholds: DataFrame | None, max_iter: int, per_firm_models: bool) -> DataFrame:
    """CHURN: training, model, metrics, scores; returns the churn part of ANALYTIC_CUSTOMER."""
    model_id = params.run_id
    raw = cf.churn_training_set(d.trx, d.cust, d.prog, params, thresholds=thresholds)
    stats = cm.fit_suppression(raw, params)
    train = cut_lineage(cm.prepare_training(raw, stats, params))
    pred = cm.model_inputs(cf.churn_prediction_set(d.trx, d.cust, d.prog, params), stats)
    work = os.path.join(out_dir, "_work", f"run_id={model_id}")
    if per_firm_models:
        store = tm.ModelStore(spark, os.path.join(out_dir, "_models"), model_id)
        paths["CHURN_MODEL_FITS"] = _of_run(tm.fit_tenants(train, store, params, max_iter), out_dir, "CHURN_MODEL_FITS", params)
        attempt = uuid.uuid4().hex[:8]
        val = tm.score_tenants(store, train.where(F.col("is_val")), os.path.join(work, f"validated-{attempt}"))
        importances = tm.tenant_importances(store, model_id, os.path.join(work, f"importances-{attempt}"))
        scored = tm.score_tenants(store, pred, os.path.join(work, f"scored-{attempt}"))
    else:
        model = cm.fit_churn(train, params, max_iter)
        val = cm.churn_probability(model, train.where(F.col("is_val")))
        # one pooled model: its importances hold for every tenant
        found = [F.struct(*[F.lit(r[c]).alias(c) for c in ("model_id", "feature", "importance")])
                 for r in cm.feature_importances(model, spark, model_id).collect()]  # a row per model input
        importances = reg.tenants(d.cust).select(F.col("ID").cast("long").alias("firm_id"), F.inline(F.array(*found)))
        scored = cm.churn_probability(model, pred)
    scored = cut_lineage(cm.postprocess(cm.shown_values(scored), params, model_id))
    paths["CHURN_PERFORMANCE_METRICS"] = _of_run(churn_performance(val.where(F.col("churn_prob").isNotNull()), params, model_id),
                                                 out_dir, "CHURN_PERFORMANCE_METRICS", params)
    paths["CHURN_FEATURE_IMPORTANCES"] = _of_run(
        sinks.with_audit(importances, params.created_by, params.audit_ts_col), out_dir, "CHURN_FEATURE_IMPORTANCES", params)
    paths["CHURN_FIRM_BASED"] = _of_run(
        sinks.with_audit(cm.churn_summary(scored), params.created_by, params.audit_ts_col, model_id),
        out_dir, "CHURN_FIRM_BASED", params)
    return _part(cust_plan.churn_p_codes(scored, params), out_dir, "CHURN", params)


def write_customers(parts: list[DataFrame], out_dir: str, params: RunParams) -> str:
    """ANALYTIC_CUSTOMER: one row per customer, segment and churn codes side by side."""
    customer = cust_plan.merge_customer_parts(*parts) if len(parts) == 2 else parts[0]
    return _write(cust_plan.audit_columns(customer, params), out_dir, "ANALYTIC_CUSTOMER")


def run_tasks(spark: SparkSession, d: Domain, out_dir: str, params: RunParams = DEFAULT,
              max_iter: int = cm.MAX_ROUNDS, per_firm_models: bool = False, tasks: DataFrame | None = None,
              resume: bool = False) -> dict[str, str]:
    """Run the modules that the task table names, each for its tenants in one pass; returns table paths.

    ``tasks``: firm_id, metric_id, display_name, working_day_period, a row per tenant and
    module; CHURN's period is the tenant's churn threshold in days. Without it every
    module runs for all active tenants, with the threshold of ``params``. STG_LOGS gets a
    PENDING event per task and then SUCCESS or FAIL; a module that fails leaves the
    others to run, and its own tables of earlier runs as they are. The customers' table is
    made of the parts that segmentation and churn have written; if that fails, so have
    both, and insight still runs. ``per_firm_models`` trains one churn model per tenant
    instead of one pooled model.

    Doing a run again (same ``params.run_id``) replaces its rows. With ``resume`` modules
    whose tasks all ended in SUCCESS in this run are not done again: what they have
    written is used; of per-tenant models only missing ones are fitted."""
    thresholds = None
    if tasks is not None:
        thresholds = tasks.where(F.col("metric_id") == reg.CHURN).select(
            "firm_id", F.col("working_day_period").alias("churn_threshold"))
    tasks = cut_lineage(reg.task_matrix(d.trx, d.cust, params) if tasks is None else tasks)
    done = cut_lineage(succeeded(spark, out_dir, params)) if resume else None
    paths: dict[str, str] = {}
    parts: dict[int, DataFrame] = {}
    names = {reg.RFM_CLV: "RFM_CLV", reg.CHURN: "CHURN"}
    started = {m: datetime.now() for m in (reg.RFM_CLV, reg.CHURN, reg.SMART_INSIGHT)}  # log times only; analytics use as_of

    def of(metric_id: int) -> DataFrame:
        return tasks.where(F.col("metric_id") == metric_id)

    def module(metric_id: int, work: Callable[[Domain], DataFrame]) -> None:
        mine = of(metric_id)
        if mine.isEmpty():
            return
        if done is not None and mine.join(done, ["firm_id", "metric_id"], "left_anti").isEmpty():
            if metric_id in names:
                parts[metric_id] = _read_part(spark, out_dir, names[metric_id], params)
            return
        started[metric_id] = datetime.now()
        paths["STG_LOGS"] = _log(mine, "PENDING", out_dir, params, started[metric_id])
        try:
            parts[metric_id] = work(_only(d, mine))
        except Exception as e:  # whatever ends a module is logged, and the next one runs
            failed([metric_id], e)
        else:
            _log(mine, "SUCCESS", out_dir, params, started[metric_id], datetime.now())

    def failed(metric_ids: list[int], e: Exception) -> None:
        for m in metric_ids:
            paths["STG_LOGS"] = _log(of(m), "FAIL", out_dir, params, started[m], datetime.now(), f"{type(e).__name__}: {e}"[:1000])

    def insight(dm: Domain) -> DataFrame:
        # firm KPIs and narrative from the segmented customers, as in the firm_kpis query
        if reg.RFM_CLV not in parts:
            raise RuntimeError("no segmented customers in this run")
        firm = ins.firm_based(parts[reg.RFM_CLV], reg.tenants(dm.cust), ins.definitions(spark), params)
        paths["ANALYTIC_FIRM_BASED"] = _write(firm, out_dir, "ANALYTIC_FIRM_BASED")
        return firm

    module(reg.RFM_CLV, lambda dm: segmentation(spark, dm, out_dir, params, paths))
    module(reg.CHURN, lambda dm: churn(spark, dm, out_dir, params, paths, thresholds, max_iter, per_firm_models))
    made = [m for m in names if m in parts]
    if made:
        try:
            paths["ANALYTIC_CUSTOMER"] = write_customers([parts[m] for m in made], out_dir, params)
        except Exception as e:  # the parts are there, but not what they are for
            failed(made, e)
    module(reg.SMART_INSIGHT, insight)
    return paths


def main(argv=None) -> None:
    """``python -m loyalflow.plans.runs --input <folder> --output <folder> [--as-of ...]``"""
    import argparse

    from ..session import build_session, shared_dir
    from ..sources.staging import staged_domain

    ap = argparse.ArgumentParser(description="Run every module for every tenant and write the output tables.")
    ap.add_argument("--input", required=True, help="folder with the source Parquet tables")
    ap.add_argument("--output", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--as-of", default=DEFAULT.as_of.strftime("%Y-%m-%d %H:%M:%S"))
    ap.add_argument("--churn-threshold", type=int, default=DEFAULT.churn_threshold)
    ap.add_argument("--max-iter", type=int, default=cm.MAX_ROUNDS)
    ap.add_argument("--per-firm-models", action="store_true", help="one churn model per tenant")
    ap.add_argument("--metrics", help="Parquet table of modules per tenant (firm_id, metric_id, display_name, working_day_period)")
    ap.add_argument("--run-id", type=int, default=DEFAULT.run_id)
    ap.add_argument("--resume", action="store_true", help="leave out modules that this run id has done")
    a = ap.parse_args(argv)
    params = DEFAULT.with_(as_of=datetime.strptime(a.as_of, "%Y-%m-%d %H:%M:%S"),
                           churn_threshold=a.churn_threshold, run_id=a.run_id)
    spark = SparkSession.getActiveSession() or build_session()
    shared_dir(spark)
    d = staged_domain(spark, a.input)
    tasks = reg.tasks_of(spark.read.parquet(a.metrics), d.trx, d.cust, params) if a.metrics else None
    paths = run_tasks(spark, d, a.output, params, a.max_iter, a.per_firm_models, tasks, a.resume)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
