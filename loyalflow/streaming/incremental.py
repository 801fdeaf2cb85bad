"""Incremental processing of arriving transactions (Structured Streaming).

Line items arrive as files in a landing folder, also late and repeatedly. A
state store drops replays: ``dropDuplicatesWithinWatermark`` on the line's key,
with the arrival time as event time, so that late *transactions* count (their own
date may be as old as it likes) and only a line seen within the horizon is
dropped. Each micro-batch is mapped to transactions - the orders are read only in
the batch's key range - and reduced to mergeable partials: count, sum, min and max
per customer, and a quantile sketch of the basket per firm.

``foreachBatch`` writes the partials of batch ``b`` into partition ``batch_id=b``
with dynamic partition overwrite, so a retried batch replaces its own output.
Every few batches the committed ones are compacted: the latest snapshot and the
partials behind it become the next snapshot, which counts once its ``_SUCCESS``
is there. Totals are the snapshot and the few partials behind it; batches that an
older snapshot holds are removed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import sinks
from ..operators.rfm import valid_transactions
from ..operators.sketches import merge_sketches, quantile_sketch, sketch_quantiles
from ..sources.domain import transactions_of

#: What tells two lines apart (line numbers repeat within an order of the test data), and what the mapping reads.
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_COLS = [*LINE_KEYS, "l_returnflag", "l_discount"]
MAPPED_COLS = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_discount"]
#: What the partials read of a transaction; nothing else of a batch is held.
PARTIAL_COLS = ["firm_id", "customer_id", "trx_state_id", "is_deleted", "transaction_date", "amount_after_discount"]
CUSTOMER_KEYS = ["firm_id", "unique_customer_id"]
KINDS = ("totals", "baskets")
#: Where state larger than memory goes: on disk, with its checkpoints in the query's checkpoint folder.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # else every key is looked up twice
}


def arriving(spark: SparkSession, landing: str, schema: T.StructType, max_files_per_trigger: int = 64) -> DataFrame:
    """Rows of the files under ``landing`` as a stream, with ``arrived_at``, when their file was written."""
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
            .select("*", F.col("_metadata.file_modification_time").alias("arrived_at")))


def without_replays(stream: DataFrame, keys: Sequence[str], horizon: str, arrived: str = "arrived_at") -> DataFrame:
    """The first of the rows with equal ``keys`` that arrive within ``horizon`` of one another.

    State holds the keys of about the last ``horizon``. Rows that arrive more than
    ``horizon`` behind the newest one are late and dropped, as the watermark says.
    """
    return stream.withWatermark(arrived, horizon).dropDuplicatesWithinWatermark(list(keys))


def customer_partials(trx: DataFrame, cust: DataFrame) -> DataFrame:
    """Mergeable per-customer partials of valid transactions."""
    per = valid_transactions(trx).groupBy("firm_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum("amount_after_discount").alias("spend"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"))
    return merge_partials(per.join(cust.select("firm_id", "customer_id", "unique_customer_id"), ["firm_id", "customer_id"]))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Running totals from the stored partials (sum of counts/sums, min of mins, max of maxes)."""
    return partials.groupBy(*CUSTOMER_KEYS).agg(
        F.sum("n_transactions").alias("n_transactions"),
        F.sum("spend").cast("decimal(28,2)").alias("spend"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"))


def basket_partials(trx: DataFrame) -> DataFrame:
    """A quantile sketch of the valid transactions' amounts per firm."""
    return quantile_sketch(valid_transactions(trx), ["firm_id"], "amount_after_discount")


def _merged(kind: str, parts: DataFrame) -> DataFrame:
    return merge_partials(parts) if kind == "totals" else merge_sketches(parts, ["firm_id"])


class PartialStore:
    """Stored partials of a stream under ``out_dir``: batches, snapshots, and what is live of them."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir

    def batches(self, kind: str) -> str:
        return os.path.join(self.out_dir, f"partials-{kind}")

    def snapshot(self, upto: int, kind: str) -> str:
        return os.path.join(self.out_dir, "snapshots", f"upto={upto}", kind)

    def committed(self) -> list[int]:
        """Last batches of the snapshots that are whole, ascending; the last kind is written last."""
        found = []
        for upto in sinks.listed(self.spark, os.path.join(self.out_dir, "snapshots"), "upto="):
            if sinks.path_exists(self.spark, os.path.join(self.snapshot(upto, KINDS[-1]), "_SUCCESS")):
                found.append(upto)
        return found

    def write(self, kind: str, partials: DataFrame, batch_id: int) -> None:
        (partials.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.batches(kind)))

    def live(self, kind: str, upto: int | None = None) -> DataFrame:
        """Partials that count: the latest snapshot and the batches behind it (up to ``upto``)."""
        snapshots = self.committed()
        last = snapshots[-1] if snapshots else -1
        # partitions at or below the snapshot are pruned, not read
        tail = self.spark.read.parquet(self.batches(kind)).where(F.col("batch_id") > last)
        if upto is not None:
            tail = tail.where(F.col("batch_id") <= upto)
        tail = tail.drop("batch_id")
        return tail if last < 0 else self.spark.read.schema(tail.schema).parquet(self.snapshot(last, kind)).unionByName(tail)

    def compact(self, upto: int) -> None:
        """One snapshot of all batches up to ``upto``, which must be committed; the batches of the snapshot before it go.

        Readers that listed the folders a moment ago still find the previous snapshot
        and what lies behind it. Doing it again changes nothing.
        """
        before = self.committed()
        if before and before[-1] >= upto:
            return
        for kind in KINDS:
            _merged(kind, self.live(kind, upto)).write.mode("overwrite").parquet(self.snapshot(upto, kind))
        if before:
            for kind in KINDS:
                for b in sinks.listed(self.spark, self.batches(kind), "batch_id="):
                    if b <= before[-1]:
                        sinks.remove(self.spark, os.path.join(self.batches(kind), f"batch_id={b}"))
            for old in before[:-1]:
                sinks.remove(self.spark, os.path.join(self.out_dir, "snapshots", f"upto={old}"))

    def totals(self) -> DataFrame:
        """Running totals per unique customer."""
        return merge_partials(self.live("totals"))

    def basket_sketches(self) -> DataFrame:
        """(firm_id, n, sketch) of all baskets so far."""
        return merge_sketches(self.live("baskets"), ["firm_id"])

    def basket_medians(self) -> DataFrame:
        """(firm_id, n, median_basket): the median within the sketch's rank bound, without reading a transaction."""
        return sketch_quantiles(self.basket_sketches(), {"median_basket": 0.5}).drop("sketch")


def order_lookup(orders: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Maps a batch of lines to transactions, reading the orders of the batch's key range only."""

    def mapped(lines: DataFrame) -> DataFrame:
        lo, hi = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
        near = orders.where(F.col("o_orderkey").between(F.lit(lo), F.lit(hi))) if lo is not None else orders.limit(0)
        return transactions_of(lines, near)

    return mapped


def run_incremental(spark: SparkSession, landing: str, schema: T.StructType, to_transactions: Callable[[DataFrame], DataFrame],
                    cust: DataFrame, out_dir: str, keys: Sequence[str] = tuple(LINE_KEYS), horizon: str = "30 days",
                    max_files_per_trigger: int = 64, compact_every: int = 16, mapped: Sequence[str] | None = None) -> PartialStore:
    """Process what has arrived in ``landing`` since the last call, and stop; returns the stored partials.

    ``to_transactions`` maps a batch of arrived rows to domain transactions; it reads the
    columns ``mapped`` of them (all, by default). Replays within ``horizon`` count once,
    across batches and calls alike.
    """
    store = PartialStore(spark, out_dir)
    lines = without_replays(arriving(spark, landing, schema, max_files_per_trigger), keys, horizon).drop("arrived_at")
    if mapped is not None:
        lines = lines.select(*mapped)

    def sink(batch: DataFrame, batch_id: int) -> None:
        snapshots = store.committed()
        # a batch that runs tells that all before it are committed
        if batch_id - 1 - (snapshots[-1] if snapshots else -1) >= compact_every:
            store.compact(batch_id - 1)
        held = batch.persist()  # read for its key range and for both partials
        try:
            trx = valid_transactions(to_transactions(held)).select(*PARTIAL_COLS).persist()
            try:
                store.write("totals", customer_partials(trx, cust), batch_id)
                store.write("baskets", basket_partials(trx), batch_id)
            finally:
                trx.unpersist()
        finally:
            held.unpersist()

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        query = (lines.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(out_dir, "_checkpoint"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return store
