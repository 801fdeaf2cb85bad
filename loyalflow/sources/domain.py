"""Domain tables of the loyalty data model.

Production reads them from the warehouse (``read_table``); the test data is a
TPC-H-like star schema, mapped here to the domain with built-in expressions
(projection + joins only, so Catalyst prunes columns and pushes filters into
the Parquet scans).

Domain tables. All carry ``firm_id``, the first part of every key: ids of
customers, transactions and programs need only be unique within a firm.

* ``trx``  firm_id, transaction_id, customer_id, program_id, trx_state_id, is_deleted,
  transaction_date (timestamp_ntz), timed_id_transaction (yyyyMMdd int),
  transaction_hour, amount_total, amount_after_discount, amount_discount,
  amount_earned_point, amount_used_point (decimal(18,2))
* ``cust`` customer_id, unique_customer_id, firm_id, program_id, is_deleted
* ``best`` firm_id, one row per unique customer with contact and demographic fields
* ``prog`` firm_id, program_id, program_name
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_checked

# Upper bound on rows for a dimension that may be broadcast.
DIM_BROADCAST_ROWS = 100_000
# Tenants of the test mapping.
FIRMS = 3


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_table(spark: SparkSession, name: str, fmt: str = "parquet", path: str | None = None,
               **options) -> DataFrame:
    """Generic reader for production tables (catalog table, Parquet/ORC path or JDBC).

    For JDBC pass ``url``, ``dbtable``, ``partitionColumn``, ``lowerBound``,
    ``upperBound``, ``numPartitions`` and ``fetchsize`` so the scan is split
    across executors instead of one cursor.
    """
    if fmt == "table":
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def unique_of(customer_id: Column) -> Column:
    """The unique customer of a customer id (two ids each)."""
    return customer_id - customer_id % 2


def firm_of(customer_id: Column) -> Column:
    """The tenant of a customer id."""
    return (unique_of(customer_id) / 2).cast("long") % FIRMS + 1


def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every firm's programs (the same ones, in the test mapping)."""
    return raw(spark, sf_dir, "region").select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.lit(FIRMS).cast("long"))).alias("firm_id"),
        F.col("r_regionkey").cast("int").alias("program_id"),
        F.col("r_name").alias("program_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = broadcast_checked(raw(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                          DIM_BROADCAST_ROWS)
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        unique_of(F.col("c_custkey")).alias("unique_customer_id"),
        firm_of(F.col("c_custkey")).alias("firm_id"),
        F.col("n_regionkey").cast("int").alias("program_id"),
        F.when(F.col("c_custkey") % 97 == 0, 1).otherwise(0).alias("is_deleted"),
    )


def customer_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per unique customer (the even customer key of each pair)."""
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    u = F.col("c_custkey")
    birth = F.date_add(F.lit("1935-01-01").cast("date"), (u * 37 % 20000).cast("int"))
    return c.where(u % 2 == 0).select(
        firm_of(u).alias("firm_id"),
        u.alias("unique_customer_id"),
        F.when(u % 7 == 0, None).otherwise(F.concat(F.lit("+90"), (F.lit(5000000000) + u).cast("string")))
        .alias("mobile_number"),
        F.when(u % 5 == 0, None).otherwise(F.concat(F.lit("c"), u.cast("string"), F.lit("@example.org")))
        .alias("email"),
        F.when(u % 11 == 0, None).otherwise(birth).alias("birth_date"),
        F.when(u % 4 == 0, "F").otherwise("M").alias("gender"),
        F.when(u % 6 == 0, "MARRIED").otherwise("SINGLE").alias("marital_status"),
        F.col("c_mktsegment").alias("occupation"),
        F.when(u % 3 == 0, "PRIMARY").when(u % 3 == 1, "SECONDARY").otherwise("UNIVERSITY").alias("education"),
        F.when(u % 10 == 0, "LEGAL").otherwise("REAL").alias("real_legal_desc"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount")
    o = raw(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    return transactions_of(li, o)


def transactions_of(li: DataFrame, o: DataFrame) -> DataFrame:
    """Transactions from line items (a table or a stream) and their orders."""
    is_ret = (F.col("l_returnflag") == "R") & F.col("l_linenumber").isin(1, 2)
    hours = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24).cast("int")
    total = _dec(F.when(is_ret, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")))
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        firm_of(F.col("o_custkey")).alias("firm_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_linenumber"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("program_id"),
        F.when(is_ret, 3).when((F.col("o_orderstatus") == "P") & (F.col("l_linenumber") == 7), 2)
        .otherwise(1).alias("trx_state_id"),
        F.when(F.col("l_orderkey") % 50 == 0, 1).otherwise(0).alias("is_deleted"),
        F.timestamp_add("HOUR", hours, F.col("o_orderdate").cast("timestamp_ntz")).alias("transaction_date"),
        total.alias("amount_total"),
        _dec(total * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("amount_after_discount"),
    )
    d = F.col("transaction_date")
    aad = F.col("amount_after_discount")
    return x.select(
        "firm_id", "transaction_id", "customer_id", "program_id", "trx_state_id", "is_deleted", "transaction_date",
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("timed_id_transaction"),
        F.hour(d).alias("transaction_hour"),
        "amount_total", "amount_after_discount",
        _dec(F.col("amount_total") - aad).alias("amount_discount"),
        _dec(F.when(F.col("trx_state_id") == 1, aad * F.lit(0.01).cast("decimal(3,2)")).otherwise(0))
        .alias("amount_earned_point"),
        _dec(F.when((F.col("trx_state_id") == 1) & (F.col("l_linenumber") == 3),
                    aad * F.lit(0.05).cast("decimal(3,2)"))).alias("amount_used_point"),
    )


@dataclass
class Domain:
    trx: DataFrame
    cust: DataFrame
    best: DataFrame
    prog: DataFrame


def load_domain(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(
        trx=transactions(spark, sf_dir),
        cust=customers(spark, sf_dir),
        best=customer_best(spark, sf_dir),
        prog=programs(spark, sf_dir),
    )


def colliding(d: Domain) -> Domain:
    """The same tables with ids counted anew in every firm, so that customers of different
    firms share customer and unique ids (a check of tenant isolation)."""
    def within(c: str) -> Column:
        return F.floor(F.col(c) / (2 * FIRMS)) * 2 + F.col(c) % 2

    return Domain(trx=d.trx.withColumn("customer_id", within("customer_id")),
                  cust=d.cust.withColumns({c: within(c) for c in ("customer_id", "unique_customer_id")}),
                  best=d.best.withColumn("unique_customer_id", within("unique_customer_id")), prog=d.prog)
