"""Sinks and catalog-level operations: Parquet round trip, per-tenant rebuild
(dynamic partition overwrite), a run's own partition, schema-aligned append, catalog
tables that are published whole, audit columns, run log, upsert. Every write goes under the shared folder (``spark.checkpoint.dir``)
or a caller-given table path - never machine-local disk.
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: job status domain ---
STATUSES = ["SUCCESS", "FAIL", "PENDING"]
# --- end of fixed values ---


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("firm_id",),
                  mode: str = "overwrite") -> None:
    """Write partitioned by tenant; with ``mode='overwrite'`` and dynamic partition
    overwrite only the tenants present in ``df`` are replaced."""
    w = (gathered(df, partition_by) if partition_by else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def gathered(df: DataFrame, partition_by: Sequence[str], files: int = 64) -> DataFrame:
    """Rows of a tenant in at most ``files`` tasks, so that a write makes at most so many files a
    tenant and not one per task, and a tenant with most rows is still split."""
    return df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))


def rebuild_tenants(df: DataFrame, path: str, partition_by: Sequence[str] = ("firm_id",)) -> None:
    """DELETE-all-then-INSERT of the tenants present in ``df``: dynamic partition overwrite
    replaces exactly their partitions and leaves other tenants untouched."""
    (gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def rebuild_all(df: DataFrame, path: str, partition_by: Sequence[str] = ("firm_id",)) -> None:
    """DELETE-all-then-INSERT of the whole table: tenants without new rows end empty."""
    (gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*partition_by).parquet(path))


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark that what stands beside it is whole."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in the names under ``folder`` (``batch_id=7``), ascending."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(p)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def replace_run(df: DataFrame, path: str, run_id: int, partition_by: Sequence[str] = ("firm_id",)) -> None:
    """The rows of one run as the partition ``run_id`` of the table at ``path``: writing a run again
    replaces it, whatever became of the first attempt, and leaves other runs as they are. From
    the second run on rows are aligned to the table's columns (see :func:`aligned`)."""
    spark = df.sparkSession
    if [r for r in listed(spark, path, "run_id=") if r != run_id]:
        df = aligned(df, spark.read.option("mergeSchema", "true").parquet(path).drop("run_id").schema)
    (gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*partition_by).parquet(os.path.join(path, f"run_id={run_id}")))


def truncate(spark: SparkSession, path: str, schema) -> None:
    """TRUNCATE: overwrite with an empty frame of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def align_to(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Keep only the columns the target has (case-insensitive), in the frame's order;
    target columns the frame lacks are left out (the table default, NULL, applies)."""
    wanted = {c.lower() for c in target_columns}
    return df.select(*[c for c in df.columns if c.lower() in wanted])


def aligned(df: DataFrame, schema) -> DataFrame:
    """The frame with exactly the columns of ``schema``, in its order and types: extra ones dropped,
    missing ones NULL."""
    kept = align_to(df, schema.names)
    have = {c.lower(): c for c in kept.columns}
    return kept.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schema.fields])


def append_aligned(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Schema-aligned append to an existing Parquet table: extra frame columns dropped,
    missing ones filled with NULL of the target type."""
    w = aligned(df, df.sparkSession.read.parquet(path).schema).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish(df: DataFrame, table: str, folder: str, partition_by: Sequence[str] = ("firm_id",)) -> str:
    """Make ``df`` the content of the catalog table ``table``; returns the location.

    The rows are written aside, in a version folder of their own under ``folder``, and the
    table's location is switched when they are whole, so that a reader sees the old rows or the
    new ones, never a part, and a failed write leaves the table as it was. The version before
    the last stays for readers that have listed it; older ones are removed.
    """
    spark = df.sparkSession
    before = listed(spark, folder, "version=")
    version = os.path.join(folder, f"version={(before[-1] if before else 0) + 1}")
    w = (gathered(df, partition_by) if partition_by else df).write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(version)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        spark.catalog.createTable(table, path=version, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    for old in before[:-1]:
        remove(spark, os.path.join(folder, f"version={old}"))
    return version


def append_to_table(df: DataFrame, table: str) -> None:
    """Schema-aligned append to a catalog table (``insertInto`` goes by position, so columns are put in the table's order)."""
    aligned(df, df.sparkSession.table(table).schema).write.insertInto(table)


def upsert_partitions(new: DataFrame, path: str, keys: Sequence[str], partition_by: str = "firm_id") -> None:
    """Upsert ``new`` into the table at ``path``, partitioned by ``partition_by`` (one of ``keys``).

    Only the partitions that ``new`` has rows of are read and rewritten; the files of the others
    are not touched. Their names, a row each, are broadcast behind a size check, so that the scan
    of the old rows is pruned by them. The merged rows are written aside first, as a partition
    cannot be read and replaced in one job.
    """
    from ..session import scratch_path
    from .joins import broadcast_checked

    if partition_by not in keys:
        raise ValueError(f"{partition_by} must be part of the key")
    spark = new.sparkSession
    kind = new.schema[partition_by].dataType
    old = spark.read.parquet(path).withColumn(partition_by, F.col(partition_by).cast(kind))
    touched = broadcast_checked(new.select(partition_by).distinct(), 100_000)
    merged = upsert(old.join(touched, partition_by, "left_semi"), aligned(new, old.schema), keys).select(*old.columns)
    aside = scratch_path(spark, f"upsert-{uuid.uuid4().hex[:8]}")
    merged.write.parquet(aside)
    rebuild_tenants(spark.read.schema(merged.schema).parquet(aside), path, (partition_by,))
    remove(spark, aside)


def with_audit(df: DataFrame, created_by: str, audit_ts_col, run_id: int | None = None) -> DataFrame:
    cols = {"created_by": F.lit(created_by), "updated_by": F.lit(created_by),
            "create_date": audit_ts_col, "update_date": audit_ts_col}
    if run_id is not None:
        cols["model_id"] = F.lit(run_id).cast("long")
    return df.withColumns(cols)


def validate_status(df: DataFrame, col: str = "status") -> DataFrame:
    """Domain check: a status outside SUCCESS/FAIL/PENDING fails the job (like the
    reference's ValueError) instead of being written."""
    c = F.col(col)
    return df.withColumn(col, F.when(c.isin(*STATUSES), c).otherwise(
        F.raise_error(F.concat(F.lit("invalid job status: "), F.coalesce(c, F.lit("NULL"))))))


def latest_status(log: DataFrame, keys: Sequence[str] = ("firm_id", "metric_id")) -> DataFrame:
    """Latest state per (firm, metric): ``max_by`` over (time, event id) - one partial/final
    aggregate, no window."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return log.groupBy(*keys).agg(
        F.max_by("status", order).alias("status"),
        F.max_by("job_type", order).alias("job_type"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert on ``keys``: rows of ``new`` replace rows of ``old`` with the same key,
    other rows of both are kept (one full outer join)."""
    keys = list(keys)
    vals = [c for c in new.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in vals], F.lit(True).alias("__in_new"))
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in vals])
    j = o.join(n, keys, "full")
    return j.select(*keys, *[F.when(F.col("__in_new"), F.col(f"__n_{c}")).otherwise(F.col(f"__o_{c}")).alias(c)
                             for c in vals])
