"""One churn model per tenant, as the reference trains per schema, in bounded plans.

Fitted pipelines are saved in a store by run and firm, so that a run that ended
goes on with the tenants that are missing. A few fits run at a time, each a
distributed job over its tenant's rows. Scoring goes in batches of tenants: a plan
holds the models of one batch, and each batch replaces its own partitions of the
scores table. The driver holds a batch of tenant ids and models, whatever their number.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, RunParams
from ..session import cut_lineage, scratch_path
from . import sinks
from .churn_model import MAX_ROUNDS, churn_probability, feature_importances, fit_churn
from .joins import broadcast_checked

#: Tenants whose ids a job may broadcast.
FIRM_ROWS = 100_000


class ModelStore:
    """Saved pipelines under ``path``, by run and firm."""

    def __init__(self, spark: SparkSession, path: str, run_id: int):
        self.spark, self.path = spark, os.path.join(path, f"run_id={run_id}")

    def _place(self, firm_id: int) -> str:
        return os.path.join(self.path, f"firm_id={firm_id}")

    def has(self, firm_id: int) -> bool:
        """Whether the firm's model is there, and whole: its stages are written after its metadata, the mark last."""
        return sinks.path_exists(self.spark, os.path.join(self._place(firm_id), "_WHOLE"))

    def save(self, firm_id: int, model: PipelineModel) -> None:
        model.write().overwrite().save(self._place(firm_id))
        sinks.touch(self.spark, os.path.join(self._place(firm_id), "_WHOLE"))

    def load(self, firm_id: int) -> PipelineModel:
        return PipelineModel.load(self._place(firm_id))

    def firms(self) -> list[int]:
        """Firms with a model, ascending."""
        return sorted(f for f in sinks.listed(self.spark, self.path, "firm_id=") if self.has(f))


def _batches(firms: DataFrame, size: int) -> Iterator[list[int]]:
    """Tenant ids in batches, read one partition at a time."""
    batch: list[int] = []
    for row in firms.sort("firm_id").toLocalIterator():
        batch.append(row.firm_id)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def fit_tenants(prepared: DataFrame, store: ModelStore, params: RunParams = DEFAULT, max_iter: int = MAX_ROUNDS, at_once: int = 4) -> DataFrame:
    """Fit and save a model for every tenant that has none yet; returns (firm_id, outcome, detail), a row per tenant.

    A tenant whose rows are all of one class gets no model (``one class``), and a fit
    that fails leaves the others to go on (``failed``).
    """
    spark = prepared.sparkSession
    data = cut_lineage(prepared)
    kinds = data.where(~F.col("is_val")).groupBy("firm_id").agg(F.count_distinct("is_churn").alias("n"))
    firms = cut_lineage(data.select("firm_id").distinct().join(kinds, "firm_id", "left"))
    log = scratch_path(spark, "fits")
    schema = "firm_id long, outcome string, detail string"

    def fit(firm: int) -> tuple[int, str, str | None]:
        if store.has(firm):
            return firm, "kept", None
        try:
            store.save(firm, fit_churn(data.where(F.col("firm_id") == firm), params, max_iter))
        except Exception as e:  # one tenant's data must not end the others' fits
            return firm, "failed", f"{type(e).__name__}: {e}"[:500]
        return firm, "fitted", None

    with ThreadPoolExecutor(at_once) as pool:
        for batch in _batches(firms.where("n = 2").select("firm_id"), 64):
            done = list(pool.map(inheritable_thread_target(spark)(fit), batch))
            spark.createDataFrame(done, schema).coalesce(1).write.mode("append").parquet(log)
    alone = firms.where(F.coalesce("n", F.lit(0)) < 2).select(
        "firm_id", F.lit("one class").alias("outcome"), F.lit(None).cast("string").alias("detail"))
    alone.write.mode("append").parquet(log)
    return spark.read.schema(schema).parquet(log)


def score_tenants(store: ModelStore, df: DataFrame, path: str, per_plan: int = 16) -> DataFrame:
    """Score each tenant's rows with its own model into the table at ``path`` (partitioned by firm) and read it back.

    Rows of tenants without a model stay, with a NULL probability.
    """
    spark = df.sparkSession
    data = cut_lineage(df)
    known = store.firms()
    for lo in range(0, len(known), per_plan):
        parts = [churn_probability(store.load(f), data.where(F.col("firm_id") == f)) for f in known[lo:lo + per_plan]]
        sinks.rebuild_tenants(reduce(lambda a, b: a.unionByName(b), parts), path)
    listed = broadcast_checked(spark.createDataFrame([(f,) for f in known], "firm_id long"), FIRM_ROWS)
    rest = data.join(listed, "firm_id", "left_anti").withColumn("churn_prob", F.lit(None).cast("double"))
    sinks.rebuild_tenants(rest.select(*data.columns, "churn_prob"), path)
    kinds = [f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in (*data.columns, "churn_prob")]
    return spark.read.schema(", ".join(kinds)).parquet(path).select(*data.columns, "churn_prob")


def tenant_importances(store: ModelStore, model_id: int, path: str, per_write: int = 256) -> DataFrame:
    """(model_id, feature, importance, firm_id) of every stored model, written in batches."""
    spark, known = store.spark, store.firms()
    for lo in range(0, len(known), per_write):
        rows = [feature_importances(store.load(f), spark, model_id, f) for f in known[lo:lo + per_write]]
        reduce(lambda a, b: a.unionByName(b), rows).write.mode("append").parquet(path)
    return spark.read.schema("model_id long, feature string, importance double, firm_id long").parquet(path) if known else \
        spark.createDataFrame([], "model_id long, feature string, importance double, firm_id long")
