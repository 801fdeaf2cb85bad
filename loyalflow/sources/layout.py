"""Co-located layout: the domain tables as catalog tables that per-customer work reads without a shuffle.

Facts carry the unique customer, resolved once when they are loaded. They lie in a folder per
month and, within it, in buckets by (firm, unique customer), sorted by time; customers and best
records lie in the same buckets. Aggregates, joins and lags per customer (``operators.colocated``)
then exchange no facts, and a window of time reads the folders of its months only.

A customer of more than ``hot_rows`` rows would make one bucket too large. The rows of such
customers, and those whose unique customer is unknown, are kept apart in a table with months but
without buckets, which the usual skew-safe operators read. No customer is in both tables, so
results per customer are put together by a union.

A customer id belongs to one unique customer of its firm; a transaction whose customer is not in
the customer table is left out, as every inner join with the customers would.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_checked
from ..operators.ranking import HOT_ROWS
from ..session import cut_lineage, scratch_path
from .domain import Domain

#: What the tables are bucketed by.
CUSTOMER = ["firm_id", "unique_customer_id"]
#: Hot customers that may be broadcast when rows are dealt out; beyond, they are joined by a shuffle.
MOST_HOT = 1_000_000
#: Rows of facts in a bucket, on average, where the number of buckets is not given.
ROWS_A_BUCKET = 2_000_000


@dataclass(frozen=True)
class Layout:
    """The tables; ``apart`` holds the facts of hot and unknown customers, or is None where there are none."""

    trx: DataFrame
    apart: DataFrame | None
    cust: DataFrame
    best: DataFrame
    prog: DataFrame


def month_of(key):
    """yyyyMM of a yyyyMMdd key; the partition column."""
    return F.floor(key / 100).cast("int")


def _buckets(trx: DataFrame) -> int:
    """Buckets for these facts: as many tasks as there are cores, or a multiple of it where that would be more than
    ``ROWS_A_BUCKET`` rows each; at most the shuffle partitions. Every bucket is a file per month, and small
    files cost more than their rows."""
    spark = trx.sparkSession
    cores = spark.sparkContext.defaultParallelism
    waves = -(-trx.count() // (cores * ROWS_A_BUCKET))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores * max(1, waves))


def _with_unique(trx: DataFrame, ids: DataFrame) -> DataFrame:
    return trx.join(ids, ["firm_id", "customer_id"]).withColumn("month", month_of(F.col("timed_id_transaction")))


def _hot_customers(trx: DataFrame, cust: DataFrame, hot_rows: int) -> DataFrame:
    """Customers of more than ``hot_rows`` rows; rows are counted per customer id before customers are joined."""
    per = trx.groupBy("firm_id", "customer_id").agg(F.count(F.lit(1)).alias("_n"))
    ids = cust.select("firm_id", "customer_id", "unique_customer_id").distinct()
    return (per.join(ids, ["firm_id", "customer_id"]).where(F.col("unique_customer_id").isNotNull())
            .groupBy(*CUSTOMER).agg(F.sum("_n").alias("_n")).where(F.col("_n") > hot_rows).select(*CUSTOMER))


def _bucketed(df: DataFrame, table: str, folder: str, buckets: int, sort: list[str], partition: str | None = None) -> None:
    """Appends to the bucketed table; a task holds one bucket, so there is one file per bucket and partition."""
    w = (df.repartition(buckets, *CUSTOMER).write.mode("append").format("parquet").option("path", os.path.join(folder, table))
         .bucketBy(buckets, *CUSTOMER).sortBy(*CUSTOMER, *sort))
    (w.partitionBy(partition) if partition else w).saveAsTable(table)


def _dealt(trx: DataFrame, cust: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts for the buckets, and those of hot or unknown customers.

    The customer ids are dealt, not the facts joined to them: the few ids of the second kind are
    broadcast, so that finding their facts exchanges none.
    """
    ids = cust.select("firm_id", "customer_id", "unique_customer_id").distinct()
    unknown = F.col("unique_customer_id").isNull()
    apart, rest = ids.where(unknown), ids.where(~unknown)
    if not hot.isEmpty():
        few = broadcast_checked(hot, MOST_HOT)
        apart = apart.unionByName(rest.join(few, CUSTOMER, "left_semi").select(*ids.columns))
        rest = rest.join(few, CUSTOMER, "left_anti").select(*ids.columns)
    return _with_unique(trx, rest), _with_unique(trx, broadcast_checked(apart, MOST_HOT))


def _deal(trx: DataFrame, cust: DataFrame, hot: DataFrame, name: str, folder: str, buckets: int) -> None:
    """Appends facts: those of hot or unknown customers to the table apart, all others to the buckets."""
    rest, apart = _dealt(trx, cust, hot)
    _bucketed(rest, f"{name}_trx", folder, buckets, ["transaction_date"], "month")
    # a month of one hot customer is spread over tasks by its transactions
    (apart.repartition(buckets, "month", F.pmod(F.xxhash64("transaction_id"), F.lit(buckets)))
     .write.mode("append").format("parquet").option("path", os.path.join(folder, f"{name}_trx_apart"))
     .partitionBy("month").saveAsTable(f"{name}_trx_apart"))


def write_layout(d: Domain, name: str, folder: str | None = None, buckets: int | None = None,
                 hot_rows: int = HOT_ROWS) -> Layout:
    """Writes the domain as the tables ``name``_trx, _trx_apart, _customers_hot, _cust, _best and _prog.

    ``folder`` (shared storage) holds their files; by default a scratch folder. ``buckets``
    follows the rows and the cores by default: choose it so that the facts of a bucket's
    longest window fit a task. The customers' rows are shuffled here, once, and by no query.
    """
    spark = d.trx.sparkSession
    folder = folder or scratch_path(spark, f"layout-{name}")
    buckets = buckets or _buckets(d.trx)
    hot = cut_lineage(_hot_customers(d.trx, d.cust, hot_rows))
    hot.write.format("parquet").option("path", os.path.join(folder, f"{name}_customers_hot")).saveAsTable(f"{name}_customers_hot")
    _deal(d.trx, d.cust, hot, name, folder, buckets)
    _bucketed(d.cust, f"{name}_cust", folder, buckets, ["customer_id"])
    _bucketed(d.best, f"{name}_best", folder, buckets, [])
    d.prog.write.format("parquet").option("path", os.path.join(folder, f"{name}_prog")).saveAsTable(f"{name}_prog")
    return open_layout(spark, name)


def append_facts(spark: SparkSession, name: str, trx: DataFrame) -> Layout:
    """Adds transactions to the layout ``name``; only folders of their months get files.

    Customers that were hot when the layout was written stay apart, all others in the buckets,
    so that no customer is in both tables; write the layout anew when others have become hot.
    """
    held = open_layout(spark, name)
    spec = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}_trx").collect()}
    folder = os.path.dirname(spec["Location"].rstrip("/"))
    _deal(trx, held.cust, spark.table(f"{name}_customers_hot"), name, folder, int(spec["Num Buckets"]))
    for table in ("trx", "trx_apart"):
        spark.catalog.refreshTable(f"{name}_{table}")
    return open_layout(spark, name)


def open_layout(spark: SparkSession, name: str) -> Layout:
    """The tables of a layout written before."""
    apart = spark.table(f"{name}_trx_apart")
    return Layout(trx=spark.table(f"{name}_trx"), apart=None if apart.isEmpty() else apart, cust=spark.table(f"{name}_cust"),
                  best=spark.table(f"{name}_best"), prog=spark.table(f"{name}_prog"))


def drop_layout(spark: SparkSession, name: str) -> None:
    """Takes the tables out of the catalog; their files stay (the tables are external)."""
    for table in ("trx", "trx_apart", "customers_hot", "cust", "best", "prog"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{table}")


def window(facts: DataFrame, from_key: int, to_key: int | None = None) -> DataFrame:
    """Facts with a date key from ``from_key`` to ``to_key`` (both inclusive); other months' folders are not read."""
    key, month = F.col("timed_id_transaction"), F.col("month")
    rows = facts.where((month >= from_key // 100) & (key >= from_key))
    return rows if to_key is None else rows.where((month <= to_key // 100) & (key <= to_key))


def window_by_firm(facts: DataFrame, windows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Facts within their own tenant's window (``windows``: firm_id, from_key, to_key, a row per tenant).

    The tenants' months are a small relation, broadcast behind a size check; the scan is pruned
    at run time by its months. Tenants without a window, or with an empty one, have no rows.
    """
    def first_day(col: str):
        return F.to_date(F.concat(F.substring(F.col(col).cast("string"), 1, 6), F.lit("01")), "yyyyMMdd")

    days = F.explode(F.sequence(first_day("from_key"), first_day("to_key"), F.expr("INTERVAL 1 MONTH")))
    months = (windows.where(F.col("from_key") <= F.col("to_key")).select("firm_id", "from_key", "to_key", days.alias("_day"))
              .select("firm_id", "from_key", "to_key", F.date_format("_day", "yyyyMM").cast("int").alias("month")))
    rows = facts.join(broadcast_checked(months, most), ["firm_id", "month"])
    return rows.where(F.col("timed_id_transaction").between(F.col("from_key"), F.col("to_key"))).select(*facts.columns)
