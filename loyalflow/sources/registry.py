"""Tenant registry, task list and job-run log.

All tenants are processed in one job keyed by ``firm_id``; the registry and the
task list are small dimensions derived from the data (one row per firm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rfm import valid_transactions
from ..params import DEFAULT, RunParams, ts_lit
from .domain import raw

# --- fixed values: analytic modules (METRIC_ID, DISPLAY_NAME, WORKING_DAY_PERIOD) ---
RFM_CLV, SMART_INSIGHT, CHURN = 1, 3, 4
METRICS = [(RFM_CLV, "RFM_CLV", 1), (SMART_INSIGHT, "SMART_INSIGHT", 7), (CHURN, "CHURN", 180)]
# Job type written to the run log per module.
JOB_TYPES = {1: "RFM_CLV", 3: "Smart Insight", 4: "Churn Model Predictions"}
# --- end of fixed values ---


def tenants(cust: DataFrame) -> DataFrame:
    """FIRMS_STG: upper-case column names, integer id, distinct rows."""
    f = cust.select("firm_id").distinct()
    t = f.select(
        F.col("firm_id").cast("int"),
        F.format_string("FIRM_%d", F.col("firm_id")),
        F.format_string("T%d_ELT", F.col("firm_id")),
        F.format_string("T%d_CDP", F.col("firm_id")),
    )
    return t.toDF("ID", "FIRM_NAME", "CONN_DATA_USER_ELT", "CONN_DATA_USER_CDP").dropDuplicates()


def metrics_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRICS, "metric_id int, display_name string, working_day_period int")


def active_tenants(trx: DataFrame, cust: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Tenants with at least one valid transaction in the 12 months before as-of."""
    recent = valid_transactions(trx).where(F.col("transaction_date") >= ts_lit(params.months_back(12)))
    return recent.select("firm_id", "customer_id").distinct().join(
        cust.select("firm_id", "customer_id"), ["firm_id", "customer_id"]).select("firm_id").distinct()


def task_matrix(trx: DataFrame, cust: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Tenant x module rows to run: active tenants, modules with a positive period
    (the module list is a literal array exploded per tenant - no join)."""
    mods = F.array(*[F.struct(F.lit(m).alias("metric_id"), F.lit(n).alias("display_name"),
                              F.lit(p).alias("working_day_period")) for m, n, p in METRICS if p > 0])
    t = active_tenants(trx, cust, params).select("firm_id", F.explode(mods).alias("m"))
    return t.select("firm_id", "m.metric_id", "m.display_name", "m.working_day_period")


def tasks_of(metrics: DataFrame, trx: DataFrame, cust: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Task rows from a table of modules per tenant (firm_id, metric_id, display_name,
    working_day_period): those of active tenants whose period is positive."""
    on = metrics.where(F.col("working_day_period") > 0).select("firm_id", "metric_id", "display_name", "working_day_period")
    return on.join(active_tenants(trx, cust, params), "firm_id", "left_semi")


def tenants_without_tasks(reg: DataFrame, tasks: DataFrame) -> DataFrame:
    """Tenants skipped because they have no task rows."""
    return reg.join(tasks.select(F.col("firm_id").cast("int").alias("ID")).distinct(), "ID", "left_anti")


def run_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job-status events derived from the event stream: firm and module from the ids,
    status from the event type (error -> FAIL, purchase -> SUCCESS, else PENDING)."""
    e = raw(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    metric = F.element_at(F.array(*[F.lit(m) for m, _, _ in METRICS]), (F.col("event_id") % 3 + 1).cast("int"))
    jt = F.create_map(*[x for k, v in JOB_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return e.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
        (F.col("user_id") % 3 + 1).alias("firm_id"),
        metric.alias("metric_id"),
        F.element_at(jt, metric).alias("job_type"),
        F.when(F.col("event_type") == "error", "FAIL").when(F.col("event_type") == "purchase", "SUCCESS")
        .otherwise("PENDING").alias("status"),
    )
