"""Streaming: replays, late transactions, compaction, retried batches, and sketches of parts."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loyalflow.operators import sinks, sketches
from loyalflow.operators.rfm import valid_transactions
from loyalflow.session import scratch_path
from loyalflow.streaming import incremental as inc

TRX = ("firm_id long, transaction_id long, customer_id long, program_id int, trx_state_id int, is_deleted int, "
       "transaction_date timestamp_ntz, amount_after_discount decimal(18,2)")


def row(firm, line, customer, day, amount):
    return firm, line, customer, 0, 1, 0, datetime(2001, 1, 1 + day, 10), Decimal(amount)


@pytest.fixture(scope="module")
def cust(spark):
    return spark.createDataFrame([(f, c, 10 * c) for f in (1, 2) for c in range(20)],
                                 "firm_id long, customer_id long, unique_customer_id long")


def same(df):
    return df  # the arriving rows are transactions already


def drop(spark, landing, name, rows):
    spark.createDataFrame(rows, TRX).coalesce(1).write.parquet(os.path.join(landing, name))


def run(spark, landing, cust, out, **more):
    schema = spark.createDataFrame([], TRX).schema
    return inc.run_incremental(spark, landing, schema, same, cust, out, keys=["firm_id", "transaction_id"],
                               max_files_per_trigger=1, compact_every=2, **more)


def totals(store):
    return {(r.firm_id, r.unique_customer_id): (r.n_transactions, r.spend, r.first_date.day, r.last_date.day)
            for r in store.totals().collect()}


def expected(rows):
    out = {}
    for firm, _, customer, _, _, _, when, amount in {(r[0], r[1]): r for r in rows}.values():
        n, spend, first, last = out.get((firm, 10 * customer), (0, Decimal(0), 99, 0))
        out[firm, 10 * customer] = n + 1, spend + amount, min(first, when.day), max(last, when.day)
    return out


def test_replays_late_rows_and_compaction(spark, cust):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "inc")
    drops = [[row(1 + i % 2, i // 2, i % 7, 10 + k, f"{i}.50") for i in range(20 * k, 20 * k + 20)] for k in range(6)]
    drops.append(drops[1][:10] + drops[4])                        # files that come again, in part
    drops.append([row(1, 900, 3, 0, "7.00"), row(1, 900, 3, 0, "7.00")])  # a late transaction, twice in one file
    drops.append([row(2, 900, 3, 0, "9.00")])                     # another firm's line of the same number
    for k, rows in enumerate(drops):
        drop(spark, landing, f"drop-{k}", rows)
        if k in (2, 6):
            store = run(spark, landing, cust, out)                # state outlives the call
    store = run(spark, landing, cust, out)
    want = expected([r for d in drops for r in d])
    assert totals(store) == want
    assert store.committed() and len(store.committed()) <= 2      # older snapshots are gone
    kept = sinks.listed(spark, store.batches("totals"), "batch_id=")
    assert min(kept) > 0 and len(kept) < 9                        # and so are the batches that they held
    again = run(spark, landing, cust, out)                        # nothing new
    assert totals(again) == want
    store.compact(max(kept))
    store.compact(max(kept))
    assert totals(store) == want


def test_a_retried_batch_and_a_broken_snapshot_count_once(spark, cust):
    out = scratch_path(spark, "store")
    store = inc.PartialStore(spark, out)
    rows = [[row(1, 10 * b + i, i, b, "5.00") for i in range(5)] for b in range(4)]
    for b in range(3):
        trx = spark.createDataFrame(rows[b], TRX)
        for _ in range(2):  # written again
            store.write("totals", inc.customer_partials(trx, cust), b)
            store.write("baskets", inc.basket_partials(trx), b)
    store.compact(1)
    # a compaction that ended between its two tables does not count
    store.live("totals").limit(1).write.parquet(store.snapshot(2, "totals"))
    assert store.committed() == [1]
    assert totals(store) == expected(sum(rows[:3], []))
    plan = store.live("totals")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan and "> 1" in plan
    store.compact(2)
    assert store.committed() == [1, 2] and totals(store) == expected(sum(rows[:3], []))
    assert store.basket_medians().first().n == 15


def test_orders_are_read_in_the_key_range_of_the_batch(spark, sf_small):
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").where("l_orderkey BETWEEN 100 AND 120").select(*inc.LINE_COLS)
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = inc.order_lookup(orders)(lines)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,1" in plan
    none = inc.order_lookup(orders)(lines.limit(0))
    assert none.count() == 0


def test_sketches_of_parts_merge_within_the_bound(spark):
    df = spark.range(0, 60_000, numPartitions=12).selectExpr(
        "id % 3 AS firm_id", "CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(pmod(xxhash64(id), 10007) AS DOUBLE) END AS v",
        "spark_partition_id() AS part")
    probs = {"q01": 0.01, "q50": 0.5, "q99": 0.99}
    parts = sketches.quantile_sketch(df, ["firm_id", "part"], "v")
    merged = sketches.merge_sketches(parts, ["firm_id"])
    assert {r.n for r in merged.collect()} == {19_600}
    q = sketches.sketch_quantiles(merged, probs)
    for r in sketches.rank_errors(df, ["firm_id"], "v", q, probs).collect():
        assert all(r[name] <= sketches.RANK_BOUND for name in probs)
    assert sketches.quantile_sketch(df.where("v IS NULL"), ["firm_id"], "v").count() == 0


def test_every_transaction_counts_in_the_test_mapping(spark, sf_small):
    from loyalflow.plans.catalog import streamed
    from loyalflow.sources.staging import staged_domain

    d = staged_domain(spark, sf_small)
    n = valid_transactions(d.trx).join(d.cust, ["firm_id", "customer_id"]).count()
    assert streamed(spark, sf_small).totals().agg(F.sum("n_transactions")).first()[0] == n


def test_landing_follows_the_tasks_and_batches_hold_what_is_read(spark, monkeypatch):
    from loyalflow.plans import catalog

    folder = scratch_path(spark, "tables")
    tables = {
        "customer": spark.range(12).selectExpr("id AS c_custkey", "CAST(0 AS INT) AS c_nationkey"),
        "nation": spark.range(1).selectExpr("CAST(id AS INT) AS n_nationkey", "CAST(0 AS INT) AS n_regionkey"),
        "orders": spark.range(200).selectExpr(
            "id AS o_orderkey", "id % 12 AS o_custkey", "'1-URGENT' AS o_orderpriority", "'O' AS o_orderstatus", "DATE'2001-02-03' AS o_orderdate"),
        "lineitem": spark.range(400).selectExpr(
            "id DIV 2 AS l_orderkey", "CAST(id % 2 + 1 AS INT) AS l_linenumber", "id AS l_partkey", "id AS l_suppkey",
            "CAST(id AS DOUBLE) AS l_extendedprice", "'N' AS l_returnflag", "CAST(0.1 AS DOUBLE) AS l_discount"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(os.path.join(folder, f"{name}.parquet"))
    landed, held = [], []
    run_it, partials = inc.run_incremental, inc.customer_partials

    def seen(spark, landing, *a, **more):
        drops = sorted(x for x in os.listdir(landing.removeprefix("file:")) if x.startswith("drop="))
        landed.append(len([f for f in os.listdir(os.path.join(landing.removeprefix("file:"), drops[-1])) if f.startswith("part-")]))
        return run_it(spark, landing, *a, **more)

    def partials_of(trx, cust):
        held.append(set(trx.columns))
        return partials(trx, cust)

    monkeypatch.setattr(inc, "run_incremental", seen)
    monkeypatch.setattr(inc, "customer_partials", partials_of)
    store = catalog.streamed(spark, folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(landed) == 2 and all(4 < n <= tasks for n in landed)
    assert held and all("transaction_hour" not in c and "program_id" not in c for c in held)
    n = sum(1 for i in range(400) if (i // 2) % 50)  # every 50th order is deleted
    assert store.totals().agg(F.sum("n_transactions")).first()[0] == n
