"""Transaction filters, churn-eligible customer base and RFM aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_diff
from ..params import DEFAULT, RunParams, ts_lit
from .joins import broadcast_checked

SALE, RETURN = 1, 3
DIM_ROWS = 100_000


def valid_transactions(trx: DataFrame, require_amount: bool = False) -> DataFrame:
    """Soft-delete filter + sale/return states (+ optional non-NULL amount)."""
    cond = (F.col("is_deleted") == 0) & F.col("trx_state_id").isin(SALE, RETURN)
    if require_amount:
        cond = cond & F.col("amount_after_discount").isNotNull()
    return trx.where(cond)


def cutoff_filter(trx: DataFrame, cutoff, side: str) -> DataFrame:
    """Split on a cut-off: ``before`` (< cutoff), ``after`` (>= cutoff), ``upto`` (<= cutoff)."""
    c = ts_lit(cutoff)
    d = F.col("transaction_date")
    cond = {"before": d < c, "after": d >= c, "upto": d <= c}[side]
    return trx.where(cond)


def customer_base(trx: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Eligible (customer, program) pairs with first/last purchase (SUM > min_spend)."""
    return (
        valid_transactions(trx)
        .groupBy("firm_id", "customer_id", "program_id")
        .agg(
            F.max("transaction_date").alias("last_purchase_date"),
            F.min("transaction_date").alias("min_purchase_date"),
            F.sum("amount_after_discount").alias("_spend"),
        )
        .where(F.col("_spend") > F.lit(params.min_spend))
        .drop("_spend")
    )


def _with_customer(per_customer: DataFrame, cust: DataFrame, prog: DataFrame) -> DataFrame:
    """Rows of (firm, customer) joined to the customer's unique id and (customer's) program."""
    c = cust.select("firm_id", "customer_id", "unique_customer_id", F.col("program_id").alias("cust_program_id"))
    p = broadcast_checked(prog.select("firm_id", F.col("program_id").alias("cust_program_id"), "program_name"),
                          DIM_ROWS)
    return per_customer.join(c, ["firm_id", "customer_id"]).join(p, ["firm_id", "cust_program_id"])


def rfm_measures(params: RunParams = DEFAULT) -> list:
    """RFM aggregates as (name, expression, merge); ``merge`` is the aggregate that
    combines partials of the measure (all of them are decomposable)."""
    st = F.col("trx_state_id")
    sale, ret = st == SALE, st == RETURN
    d = F.col("transaction_date").cast("date")
    aad = F.col("amount_after_discount")
    tid = F.col("transaction_id")
    earned = F.coalesce(F.col("amount_earned_point"), F.lit(0).cast("decimal(18,2)"))
    used = F.coalesce(F.col("amount_used_point"), F.lit(0).cast("decimal(18,2)"))
    return [
        ("son_alv_tarih", F.max(F.when(sale, F.col("timed_id_transaction"))), F.max),
        ("son_iade_tarih", F.max(F.when(ret, F.col("timed_id_transaction"))), F.max),
        ("_last_any", F.max(d), F.max),
        ("_last_sale", F.max(F.when(sale, d)), F.max),
        ("_last_ret", F.max(F.when(ret, d)), F.max),
        ("frequency", F.count(tid), F.sum),
        ("frequency_gecerli", F.count(F.when(sale, tid)), F.sum),
        ("frequency_iade", F.count(F.when(ret, tid)), F.sum),
        ("_monetary", F.sum(aad), F.sum),
        ("_monetary_sale", F.sum(F.when(sale, aad)), F.sum),
        ("_monetary_ret", F.sum(F.when(ret, aad)), F.sum),
        ("_earned", F.sum(earned), F.sum),
        ("_used", F.sum(used), F.sum),
        ("kazanilan_trx_cnt", F.sum(F.when(F.col("amount_earned_point") > 0, 1).otherwise(0)).cast("long"), F.sum),
        ("harcanilan_trx_cnt", F.sum(F.when(F.col("amount_used_point") > 0, 1).otherwise(0)).cast("long"), F.sum),
    ]


def rfm_finish(g: DataFrame, params: RunParams = DEFAULT, with_ratios: bool = True) -> DataFrame:
    """HAVING on spend, then recency / ratio columns from the aggregated measures."""
    g = g.where(F.col("_monetary") > F.lit(params.min_spend))
    today = params.as_of_date_col
    rec = day_diff(today, "_last_any")
    rec_sale = day_diff(today, "_last_sale")
    rec_ret = day_diff(today, "_last_ret")
    out = g.select(
        "firm_id", "unique_customer_id", "kart_tip_detay", "son_alv_tarih", "son_iade_tarih",
        rec.alias("recency"), rec_sale.alias("recency_gecerli"), rec_ret.alias("recency_iade"),
        F.when(rec_ret <= rec_sale, 1).otherwise(0).alias("son_islem_iade"),
        F.col("frequency").cast("long").alias("frequency"),
        F.col("frequency_gecerli").cast("long").alias("frequency_gecerli"),
        F.col("frequency_iade").cast("long").alias("frequency_iade"),
        F.round(F.try_divide(F.col("frequency_iade").cast("double"), F.col("frequency").cast("double")), 4)
        .alias("iade_orani"),
        F.col("_monetary").alias("monetary"),
        F.col("_monetary_sale").alias("monetary_gecerli"),
        F.col("_monetary_ret").alias("monetary_iade"),
        F.try_divide(-F.col("_monetary_ret").cast("double"), F.col("_monetary_sale").cast("double"))
        .alias("iade_ciro_orani"),
        F.col("_earned").alias("kazanilan_tutar"),
        F.col("_used").alias("harcanan_tutar"),
        F.round(F.coalesce(F.try_divide(F.col("_used").cast("double"),
                                        F.nullif(F.col("_earned").cast("double"), F.lit(0.0))),
                           F.lit(0.0)), 4).alias("kazanilan_harcanan_tutar_oran"),
        F.col("kazanilan_trx_cnt").cast("long").alias("kazanilan_trx_cnt"),
        F.col("harcanilan_trx_cnt").cast("long").alias("harcanilan_trx_cnt"),
    )
    if not with_ratios:
        out = out.drop("iade_orani", "iade_ciro_orani", "kazanilan_harcanan_tutar_oran")
    return out


def rfm_aggregate(trx: DataFrame, cust: DataFrame, prog: DataFrame,
                  params: RunParams = DEFAULT, with_ratios: bool = True) -> DataFrame:
    """RFM_STG: recency / frequency / monetary / points per (unique customer, program name).

    The transactions are aggregated per (firm, customer) first, with a map-side partial, so
    that customers' measures and not transactions meet the customer table; the measures are
    then merged per unique customer and program. HAVING on the spend total.
    """
    measures = rfm_measures(params)
    per = valid_transactions(trx).groupBy("firm_id", "customer_id").agg(*[e.alias(n) for n, e, _ in measures])
    g = _with_customer(per, cust, prog).groupBy(
        "firm_id", "unique_customer_id", F.col("program_name").alias("kart_tip_detay")).agg(
        *[merge(n).cast(per.schema[n].dataType).alias(n) for n, _, merge in measures])
    return rfm_finish(g, params, with_ratios)
