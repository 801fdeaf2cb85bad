"""Per-customer operators over the co-located layout (``sources.layout``): facts are not exchanged.

Facts, customers and best records lie in the same buckets by (firm, unique customer). Each
operator runs over the buckets without a shuffle of facts, and over the customers kept apart
by the usual skew-safe operator; the union of both is its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, RunParams
from ..sources.layout import CUSTOMER, Layout, window
from . import churn_features as cf
from . import profile as prof
from . import rfm
from .joins import broadcast_checked


def per_customer(lay: Layout, in_buckets: Callable[[DataFrame], DataFrame],
                 apart: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows per customer: ``in_buckets`` of the bucketed facts and ``apart`` of the others, no customer in both."""
    out = in_buckets(lay.trx)
    return out if lay.apart is None else out.unionByName(apart(lay.apart.drop("unique_customer_id")))


def with_customers(rows: DataFrame, cust: DataFrame) -> DataFrame:
    """Rows joined to the columns of ``cust`` of the same customer id. The join's keys are those of the
    buckets; that the customer id is the same is a condition on what meets (a few ids per unique customer)."""
    c = cust.withColumnRenamed("customer_id", "_id")
    same = F.coalesce(F.col("customer_id") == F.col("_id"), F.lit(False))
    return rows.join(c.hint("merge"), CUSTOMER).where(same).drop("_id")


def _customer_programs(lay: Layout) -> DataFrame:
    return lay.cust.select("firm_id", "customer_id", "unique_customer_id", F.col("program_id").alias("cust_program_id"))


def rfm_aggregate(lay: Layout, params: RunParams = DEFAULT) -> DataFrame:
    """RFM_STG, as :func:`rfm.rfm_aggregate`; no exchange at all in the buckets."""
    measures = rfm.rfm_measures(params)

    def in_buckets(trx: DataFrame) -> DataFrame:
        per = rfm.valid_transactions(trx).groupBy(*CUSTOMER, "customer_id").agg(*[e.alias(n) for n, e, _ in measures])
        p = broadcast_checked(lay.prog.select("firm_id", F.col("program_id").alias("cust_program_id"), "program_name"),
                              rfm.DIM_ROWS)
        g = (with_customers(per, _customer_programs(lay)).join(p, ["firm_id", "cust_program_id"])
             .groupBy(*CUSTOMER, F.col("program_name").alias("kart_tip_detay"))
             .agg(*[merge(n).cast(per.schema[n].dataType).alias(n) for n, _, merge in measures]))
        return rfm.rfm_finish(g, params)

    return per_customer(lay, in_buckets, lambda trx: rfm.rfm_aggregate(trx, lay.cust, lay.prog, params))


def purchase_profile(lay: Layout, params: RunParams = DEFAULT) -> DataFrame:
    """ANALYTICAL_PROFILE, as :func:`profile.purchase_profile`; reads the folders of 24 months only."""

    def in_buckets(trx: DataFrame) -> DataFrame:
        t = window(rfm.valid_transactions(trx), params.profile_key)
        p = broadcast_checked(lay.prog.select("firm_id", F.col("program_id").alias("cust_program_id")), prof.DIM_ROWS)
        x = with_customers(t, _customer_programs(lay)).join(p, ["firm_id", "cust_program_id"])
        return prof.profile_of(x, lay.best, params)

    return per_customer(lay, in_buckets, lambda trx: prof.purchase_profile(
        window(trx, params.profile_key), lay.cust, lay.best, lay.prog, params))


def all_data(lay: Layout, params: RunParams = DEFAULT) -> DataFrame:
    """ANALYTIC_ALL_DATA: the profile joined to the RFM rows of the same customer, bucket by bucket."""
    return prof.all_data(rfm_aggregate(lay, params), purchase_profile(lay, params))


def transaction_features(lay: Layout, params: RunParams = DEFAULT, mode: str = "train") -> DataFrame:
    """TRANSACTION_FEATURES, as :func:`churn_features.transaction_features`: the lag, the ranks and the aggregate
    read the buckets once, as they lie; nothing is written or exchanged for them."""

    def in_buckets(trx: DataFrame) -> DataFrame:
        live = lay.cust.where(F.col("is_deleted") == 0).select("firm_id", "customer_id", "unique_customer_id")
        x = with_customers(cf.priced_transactions(trx, params, mode), live).select(*cf.LAG_COLS)
        return cf.features_of(x, hot_rows=None)

    def apart(trx: DataFrame) -> DataFrame:
        return cf.transaction_features(cf.feature_transactions(trx, lay.cust, params, mode))

    return per_customer(lay, in_buckets, apart)
