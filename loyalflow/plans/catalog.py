"""Registered check queries: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL | None)``.

Every query reads the given tables (or frames Spark derives from them) over
whole tables; nothing is sampled, capped or filtered to keep the check cheap.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile as prof
from ..operators import rfm as rfm_ops
from ..operators import colocated, scalers, sketches
from ..params import DEFAULT, ts_lit
from ..session import apply_conf, cut_lineage
from ..sources.layout import window, window_by_firm
from ..sources.staging import staged_domain, staged_layout
from . import oracle as O
from .normalize import norm, sql_norm

P = DEFAULT


@dataclass
class Check:
    spark_fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Check] = {}


def register(name: str, sql: str | None = None, money=(), rnd: dict | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return norm(fn(spark, sf_dir), money, rnd)

        run.__name__ = name
        REGISTRY[name] = Check(run, sql_norm(sql, money, rnd) if sql is not None else None)
        return fn

    return deco


def dom(spark, sf_dir):
    """Domain tables of ``sf_dir`` (staged once per input folder, then read as tables)."""
    return staged_domain(spark, sf_dir)


# ----------------------------------------------------------------- sources / filters
SCAN_MONEY = ["sum_total", "sum_after_discount", "sum_discount", "sum_earned_point", "sum_used_point"]


@register("scan_transactions", O.with_domain(body="""
SELECT trx_state_id, is_deleted, count(*) AS n_rows, count(DISTINCT transaction_id) AS n_ids,
  sum(amount_total) AS sum_total, sum(amount_after_discount) AS sum_after_discount,
  sum(amount_discount) AS sum_discount, sum(amount_earned_point) AS sum_earned_point,
  sum(amount_used_point) AS sum_used_point
FROM trx GROUP BY trx_state_id, is_deleted"""), money=SCAN_MONEY)
def scan_transactions(spark, sf_dir):
    return dom(spark, sf_dir).trx.groupBy("trx_state_id", "is_deleted").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("transaction_id").alias("n_ids"),
        F.sum("amount_total").alias("sum_total"),
        F.sum("amount_after_discount").alias("sum_after_discount"),
        F.sum("amount_discount").alias("sum_discount"),
        F.sum("amount_earned_point").alias("sum_earned_point"),
        F.sum("amount_used_point").alias("sum_used_point"),
    )


@register("valid_transactions", O.with_domain(body="""
SELECT program_id, count(*) AS n_rows, sum(amount_after_discount) AS revenue
FROM valid WHERE amount_after_discount IS NOT NULL GROUP BY program_id"""), money=["revenue"])
def valid_transactions(spark, sf_dir):
    t = rfm_ops.valid_transactions(dom(spark, sf_dir).trx, require_amount=True)
    return t.groupBy("program_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum("amount_after_discount").alias("revenue"))


@register("window_24m", O.with_domain(body=f"""
SELECT c.firm_id, count(*) AS n_rows
FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
WHERE t.timed_id_transaction >= {P.profile_key} GROUP BY c.firm_id"""))
def window_24m(spark, sf_dir):
    d = dom(spark, sf_dir)
    t = rfm_ops.valid_transactions(d.trx).where(F.col("timed_id_transaction") >= F.lit(P.profile_key))
    per = t.groupBy("firm_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(d.cust.select("firm_id", "customer_id"), ["firm_id", "customer_id"]).groupBy("firm_id").agg(
        F.sum("n").alias("n_rows"))


@register("cutoff_split", O.with_domain(
    "ref AS (SELECT " + O.ts(P.as_of) + f" - INTERVAL {P.churn_threshold} DAY AS cutoff)",
    body="""
SELECT c.firm_id, c.unique_customer_id,
  count(CASE WHEN t.transaction_date < r.cutoff THEN 1 END) AS n_before,
  count(CASE WHEN t.transaction_date >= r.cutoff THEN 1 END) AS n_after
FROM valid t CROSS JOIN ref r JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
GROUP BY c.firm_id, c.unique_customer_id"""))
def cutoff_split(spark, sf_dir):
    """Pre/post cut-off counts per unique customer. The reference crosses in a one-row
    relation holding the cut-off; here it is a literal, constant-folded into the filter."""
    d = dom(spark, sf_dir)
    cutoff = ts_lit(P.churn_cutoff)
    per = rfm_ops.valid_transactions(d.trx).groupBy("firm_id", "customer_id").agg(
        F.count(F.when(F.col("transaction_date") < cutoff, 1)).alias("n_before"),
        F.count(F.when(F.col("transaction_date") >= cutoff, 1)).alias("n_after"),
    )
    c = d.cust.select("firm_id", "customer_id", "unique_customer_id")
    return per.join(c, ["firm_id", "customer_id"]).groupBy("firm_id", "unique_customer_id").agg(
        F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))


@register("customer_base", O.with_domain(body=f"""
SELECT firm_id, customer_id, program_id, max(transaction_date) AS last_purchase_date,
  min(transaction_date) AS min_purchase_date
FROM valid GROUP BY firm_id, customer_id, program_id HAVING sum(amount_after_discount) > {P.min_spend}"""))
def customer_base(spark, sf_dir):
    return rfm_ops.customer_base(dom(spark, sf_dir).trx, P)


# ----------------------------------------------------------------- RFM
RFM_MONEY = ["monetary", "monetary_gecerli", "monetary_iade", "kazanilan_tutar", "harcanan_tutar"]
RFM_KEYS = "firm_id, unique_customer_id, kart_tip_detay"
RFM_PLAIN = ("son_alv_tarih, son_iade_tarih, recency, recency_gecerli, recency_iade, son_islem_iade, frequency, "
             "frequency_gecerli, frequency_iade, monetary, monetary_gecerli, monetary_iade, kazanilan_tutar, "
             "harcanan_tutar, kazanilan_trx_cnt, harcanilan_trx_cnt")
RATIO_COLS = ["iade_orani", "iade_ciro_orani", "kazanilan_harcanan_tutar_oran"]


def rfm_frame(spark, sf_dir):
    d = dom(spark, sf_dir)
    return rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, P)


@register("rfm_aggregate", O.with_domain(O.rfm_cte(), body=f"SELECT {RFM_KEYS}, {RFM_PLAIN} FROM rfm"),
          money=RFM_MONEY)
def rfm_aggregate(spark, sf_dir):
    return rfm_frame(spark, sf_dir).drop(*RATIO_COLS)


@register("return_ratios", O.with_domain(O.rfm_cte(), body=f"SELECT {RFM_KEYS}, {', '.join(RATIO_COLS)} FROM rfm"),
          rnd={c: 4 for c in RATIO_COLS})
def return_ratios(spark, sf_dir):
    return rfm_frame(spark, sf_dir).select("firm_id", "unique_customer_id", "kart_tip_detay", *RATIO_COLS)


# ----------------------------------------------------------------- profile
PROFILE_MONEY = ["musteri_toplam_ciro", "sabah_alisveris_ciro", "oglen_alisveris_ciro", "aksam_alisveris_ciro",
                 "gece_alisveris_ciro", "haftasonu_alv_ciro", "haftaici_alv_ciro", "son_1_ay_toplam_ciro",
                 "son_3_ay_toplam_ciro", "son_6_ay_toplam_ciro", "son_1_yil_toplam_ciro"]
PROFILE_DOUBLES = ["ind_alv_orani", "ort_indirim_orani", "son_1_ay_ort_ciro", "son_3_ay_ort_ciro",
                   "son_6_ay_ort_ciro", "son_1_yil_ort_ciro"]


def profile_frame(spark, sf_dir):
    d = dom(spark, sf_dir)
    return prof.purchase_profile(d.trx, d.cust, d.best, d.prog, P)


def _register_slice(name):
    cols = prof.SLICES[name]
    money = [c for c in cols if c in PROFILE_MONEY]
    rnd = {c: 6 for c in cols if c in PROFILE_DOUBLES}
    sql = O.with_domain(O.profile_cte(), body=f"SELECT firm_id, unique_customer_id, {', '.join(cols)} FROM profile")

    @register(name, sql, money=money, rnd=rnd)
    def _slice(spark, sf_dir):
        return prof.profile_slice(profile_frame(spark, sf_dir), name)


for _name in prof.SLICES:
    _register_slice(_name)


@register("purchase_profile", O.with_domain(O.profile_cte(), body="SELECT * FROM profile"),
          money=PROFILE_MONEY, rnd={c: 6 for c in PROFILE_DOUBLES})
def purchase_profile(spark, sf_dir):
    return profile_frame(spark, sf_dir)


def all_data_frame(spark, sf_dir):
    d = dom(spark, sf_dir)
    return prof.all_data(rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, P),
                         prof.purchase_profile(d.trx, d.cust, d.best, d.prog, P))


@register("all_data", O.with_domain(O.rfm_cte(), O.profile_cte(), O.all_data_cte(), body="SELECT * FROM all_data"),
          money=PROFILE_MONEY + RFM_MONEY,
          rnd={**{c: 6 for c in PROFILE_DOUBLES}, **{c: 4 for c in RATIO_COLS}})
def all_data(spark, sf_dir):
    return all_data_frame(spark, sf_dir)


# ----------------------------------------------------------------- segmentation
from ..functions.dates import parse_date_key  # noqa: E402
from ..operators import reshape  # noqa: E402
from ..operators import segments as seg_ops  # noqa: E402
from . import customer as cust_plan  # noqa: E402

SEG = O.segments_ctes()


def seg_rows(spark, sf_dir):
    return cust_plan.segmented_rows(dom(spark, sf_dir), P)


ROW_KEYS = "firm_id, unique_customer_id, kart_tip_detay"
ROW_KEY_COLS = ["firm_id", "unique_customer_id", "kart_tip_detay"]
DATE_KEY_EXPR_SQL = ("CASE transaction_id % 3 WHEN 0 THEN timed_id_transaction "
                     "WHEN 1 THEN timed_id_transaction + cast(transaction_id % 40 AS INTEGER) "
                     "ELSE timed_id_transaction % 10000000 END")


@register("date_key_parse", O.with_domain(body=f"""
SELECT cast(year(d) AS INTEGER) AS parsed_year, count(*) AS n_rows FROM (
  SELECT {O._parse_key('k')} AS d FROM (SELECT {DATE_KEY_EXPR_SQL} AS k FROM trx) s) p
WHERE d IS NOT NULL GROUP BY year(d)"""))
def date_key_parse(spark, sf_dir):
    """Zero-filled ``yyyyMMdd`` parse of valid, shifted (often invalid) and 7-digit keys;
    unparseable keys are dropped."""
    t = dom(spark, sf_dir).trx
    tid, key = F.col("transaction_id"), F.col("timed_id_transaction")
    k = (F.when(tid % 3 == 0, key).when(tid % 3 == 1, key + (tid % 40).cast("int"))
         .otherwise(key % 10000000))
    parsed = t.select(parse_date_key(k).alias("d")).dropna(subset=["d"])
    return parsed.groupBy(F.year("d").alias("parsed_year")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("recency_segment", O.with_domain(*SEG, body=f"SELECT {ROW_KEYS}, recency_segment FROM seg"))
def recency_segment(spark, sf_dir):
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "recency_segment")


@register("minmax_scaled", O.with_domain(*SEG, body=f"""
SELECT {ROW_KEYS}, monetary_scaled, frequency_scaled, monetary_sqrt, frequency_sqrt FROM seg"""),
          rnd={"monetary_scaled": 6, "frequency_scaled": 6, "monetary_sqrt": 4, "frequency_sqrt": 4})
def minmax_scaled(spark, sf_dir):
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "monetary_scaled", "frequency_scaled",
                                          "monetary_sqrt", "frequency_sqrt")


SCALED = ["recency", "frequency", "monetary"]


def _scaled_sql(shift: str, width: str):
    shown = ", ".join(f"CASE WHEN w_{c} = 0 THEN 0 ELSE (cast(r.{c} AS DOUBLE) - s_{c}) / w_{c} END AS {c}_scaled" for c in SCALED)
    stats = ", ".join(f"{shift.format(c=c)} AS s_{c}, {width.format(c=c)} AS w_{c}" for c in SCALED)
    return O.with_domain(O.rfm_cte(), body=f"""
SELECT r.firm_id, r.unique_customer_id, r.kart_tip_detay, {shown}
FROM rfm r JOIN (SELECT firm_id, {stats} FROM rfm WHERE frequency > 1 GROUP BY firm_id) s ON r.firm_id = s.firm_id""")


def _scaled(spark, sf_dir, kind):
    """Scaler fitted on customers who came back, applied to all."""
    r = rfm_frame(spark, sf_dir)
    fitted = cut_lineage(scalers.fit_scaler(r.where("frequency > 1"), SCALED, kind))
    return scalers.scale(r, fitted, SCALED).select("firm_id", "unique_customer_id", "kart_tip_detay", *[f"{c}_scaled" for c in SCALED])


@register("standard_scaled", _scaled_sql("avg(cast({c} AS DOUBLE))", "stddev_pop(cast({c} AS DOUBLE))"),
          rnd={f"{c}_scaled": 6 for c in SCALED})
def standard_scaled(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@register("robust_scaled", _scaled_sql("quantile_cont(cast({c} AS DOUBLE), 0.5)",
                                       "quantile_cont(cast({c} AS DOUBLE), 0.75) - quantile_cont(cast({c} AS DOUBLE), 0.25)"),
          rnd={f"{c}_scaled": 6 for c in SCALED})
def robust_scaled(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@register("clv_quantile_sketch", O.with_domain(*SEG, body="""
SELECT firm_id, count(*) AS n, true AS q30_within, true AS q50_within, true AS q80_within FROM seg GROUP BY firm_id"""))
def clv_quantile_sketch(spark, sf_dir):
    """q30/q50/q80 of CLV per firm from sketches of each program's customers, merged; their exact ranks lie within the bound."""
    rows = cut_lineage(seg_rows(spark, sf_dir).select("firm_id", "kart_tip_detay", "clv"))
    probs = {"q30": 0.3, "q50": 0.5, "q80": 0.8}
    parts = sketches.quantile_sketch(rows, ["firm_id", "kart_tip_detay"], "clv")
    merged = sketches.sketch_quantiles(sketches.merge_sketches(parts, ["firm_id"]), probs)
    errors = sketches.rank_errors(rows, ["firm_id"], "clv", merged, probs)
    return errors.select("firm_id", "n", *[(F.col(q) <= sketches.RANK_BOUND).alias(f"{q}_within") for q in probs])


@register("monetary_segment", O.with_domain(*SEG, body="""
SELECT firm_id, monetary_segment, count(*) AS n_rows FROM seg GROUP BY firm_id, monetary_segment"""))
def monetary_segment(spark, sf_dir):
    return seg_rows(spark, sf_dir).groupBy("firm_id", "monetary_segment").agg(F.count(F.lit(1)).alias("n_rows"))


@register("frequency_segment", O.with_domain(*SEG, body="""
SELECT firm_id, frequency_segment, count(*) AS n_rows FROM seg GROUP BY firm_id, frequency_segment"""))
def frequency_segment(spark, sf_dir):
    return seg_rows(spark, sf_dir).groupBy("firm_id", "frequency_segment").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("discount_segments", O.with_domain(*SEG, body=f"""
SELECT {ROW_KEYS}, indirim_duyarli_segment, indirim_beklentisi_segment FROM seg"""))
def discount_segments(spark, sf_dir):
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "indirim_duyarli_segment", "indirim_beklentisi_segment")


@register("clv_value", O.with_domain(*SEG, body=f"""
SELECT {ROW_KEYS}, customer_lifespan, avg_purchase_value, avg_purchase_frequency_rate, clv FROM seg"""),
          rnd={"avg_purchase_value": 6})
def clv_value(spark, sf_dir):
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "customer_lifespan", "avg_purchase_value",
                                          "avg_purchase_frequency_rate", "clv")


CLV_Q_COLS = [f"{m}_{q}" for m in ("clv", "aov", "freq", "life") for q in ("q30", "q50", "q80")]


@register("clv_thresholds", O.with_domain(*SEG, body="SELECT * FROM clv_q"), rnd={c: 4 for c in CLV_Q_COLS})
def clv_thresholds(spark, sf_dir):
    rows = seg_ops.clv_values(seg_ops.rfm_segments(cust_plan.segmentation_input(dom(spark, sf_dir), P), P))
    return seg_ops.clv_thresholds(rows)


@register("clv_segment", O.with_domain(*SEG, body=f"SELECT {ROW_KEYS}, clv_segment FROM seg"))
def clv_segment(spark, sf_dir):
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "clv_segment")


@register("rfm_scores", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, unique_customer_id, kart_tip_detay, r_score, f_score, m_score,
  concat(cast(r_score AS VARCHAR), cast(f_score AS VARCHAR), cast(m_score AS VARCHAR)) AS rfm_score
FROM (SELECT firm_id, unique_customer_id, kart_tip_detay,
  cast(ntile(5) OVER (PARTITION BY firm_id ORDER BY recency DESC, unique_customer_id, kart_tip_detay) AS INTEGER) AS r_score,
  cast(ntile(5) OVER (PARTITION BY firm_id ORDER BY frequency, unique_customer_id, kart_tip_detay) AS INTEGER) AS f_score,
  cast(ntile(5) OVER (PARTITION BY firm_id ORDER BY cast(monetary AS DOUBLE), unique_customer_id, kart_tip_detay) AS INTEGER) AS m_score
  FROM rfm) s"""))
def rfm_scores(spark, sf_dir):
    d = dom(spark, sf_dir)
    return seg_ops.rfm_scores(rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, P))


@register("customer_collapse", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, unique_customer_id, min(kart_tip_detay) AS kart_tip_detay,
  arg_min(monetary, kart_tip_detay) AS monetary, arg_min(frequency, kart_tip_detay) AS frequency,
  arg_min(recency, kart_tip_detay) AS recency
FROM rfm GROUP BY firm_id, unique_customer_id"""), money=["monetary"])
def customer_collapse(spark, sf_dir):
    d = dom(spark, sf_dir)
    r = rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, P)
    return reshape.collapse_first(r, ["firm_id", "unique_customer_id"], "kart_tip_detay",
                                  ["monetary", "frequency", "recency"])


LONG_METRICS = {"recency": "P3", "frequency": "P4", "recency_segment": "P6", "customer_lifespan": "P11",
                "clv_segment": "P15"}


def _long_sql():
    vals = " UNION ALL ".join(
        f"SELECT {ROW_KEYS}, '{m}' AS metric_name, cast({m} AS VARCHAR) AS value FROM seg" for m in LONG_METRICS)
    defs = ", ".join(f"('{m}', '{c}')" for m, c in LONG_METRICS.items())
    return (f"lng AS ({vals}), defs AS (SELECT * FROM (VALUES {defs}) v(metric_name, p_code)), "
            f"coded AS (SELECT l.*, d.p_code FROM lng l JOIN defs d ON l.metric_name = d.metric_name)")


def long_frame(spark, sf_dir):
    rows = seg_rows(spark, sf_dir)
    lng = reshape.melt(rows, ROW_KEY_COLS, list(LONG_METRICS))
    return reshape.attach_codes(lng, reshape.definitions(spark, LONG_METRICS))


@register("p_code_long", O.with_domain(*SEG, _long_sql(), body=f"""
SELECT {ROW_KEYS}, metric_name, p_code, value FROM coded"""))
def p_code_long(spark, sf_dir):
    return long_frame(spark, sf_dir).select(*ROW_KEY_COLS, "metric_name", "p_code", "value")


@register("p_code_wide", O.with_domain(*SEG, _long_sql(), body="SELECT firm_id, unique_customer_id, " + ", ".join(
    f"arg_min(CASE WHEN p_code = '{c}' THEN value END, CASE WHEN p_code = '{c}' AND value IS NOT NULL "
    f"THEN kart_tip_detay END) AS {c}" for c in LONG_METRICS.values())
    + " FROM coded GROUP BY firm_id, unique_customer_id"))
def p_code_wide(spark, sf_dir):
    return reshape.pivot_first(long_frame(spark, sf_dir), ["firm_id", "unique_customer_id"], "kart_tip_detay",
                               list(LONG_METRICS.values()))


AC_CODES = list(reshape.SEGMENT_P_CODES.values())


@register("analytic_customer", O.with_domain(*SEG, O.analytic_customer_cte(), body=f"""
SELECT firm_id, unique_customer_id, {', '.join(AC_CODES)}, '{P.created_by}' AS created_by,
  '{P.created_by}' AS updated_by, {O.audit_ts(P)} AS create_date, {O.audit_ts(P)} AS update_date
FROM ac"""))
def analytic_customer(spark, sf_dir):
    return cust_plan.analytic_customer(seg_rows(spark, sf_dir), P)


# ----------------------------------------------------------------- churn features
from ..operators import churn_features as cf  # noqa: E402

CH_TRAIN = O.churn_ctes(P, "train")
CH_PRED = O.churn_ctes(P, "predict")
CH_MONEY = ["total_spent", "max_spent", "min_spent", "avg_spent", "total_discount_earned", "total_used_point",
            "total_earned_point"]
CH_RND = {"days_since_last_transaction": 6, "customer_lifetime": 6,
          "avg_days_between_transactions": 6, "median_basket_size": 6, "basket_size_stddev": 4}
CH_KEYS = ["firm_id", "unique_customer_id", "program_id"]


def churn_x(spark, sf_dir, mode="train"):
    d = dom(spark, sf_dir)
    return d, cf.feature_transactions(d.trx, d.cust, P, mode)


@register("interpurchase_gap", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, unique_customer_id, program_id, avg_days_between_transactions FROM feats"""),
          rnd={"avg_days_between_transactions": 6})
def interpurchase_gap(spark, sf_dir):
    _, x = churn_x(spark, sf_dir)
    return cf.transaction_features(x).select(*CH_KEYS, "avg_days_between_transactions")


@register("median_basket", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, unique_customer_id, program_id, median_basket_size FROM feats"""), rnd={"median_basket_size": 6})
def median_basket(spark, sf_dir):
    _, x = churn_x(spark, sf_dir)
    return cf.transaction_features(x).select(*CH_KEYS, "median_basket_size")


@register("basket_stddev", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, unique_customer_id, program_id, basket_size_stddev FROM feats"""), rnd={"basket_size_stddev": 4})
def basket_stddev(spark, sf_dir):
    _, x = churn_x(spark, sf_dir)
    return cf.transaction_features(x).select(*CH_KEYS, "basket_size_stddev")


@register("churn_customer_base", O.with_domain(*CH_TRAIN, body="SELECT * FROM cbase"),
          money=CH_MONEY[:4], rnd={k: v for k, v in CH_RND.items() if k in cf.BASE_COLS})
def churn_customer_base(spark, sf_dir):
    d, x = churn_x(spark, sf_dir)
    return cf.customer_base(x, d.prog, P, "train")


@register("churn_label", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, unique_customer_id, program_id, transactions_after_cutoff, is_churn FROM ds"""))
def churn_label(spark, sf_dir):
    d = dom(spark, sf_dir)
    return cf.churn_dataset(d.trx, d.cust, d.prog, P).select(*CH_KEYS, "transactions_after_cutoff", "is_churn")


def training_frame(spark, sf_dir):
    d = dom(spark, sf_dir)
    return cf.churn_training_set(d.trx, d.cust, d.prog, P)


@register("churn_training_set", O.with_domain(*CH_TRAIN, body="SELECT * FROM train"), money=CH_MONEY, rnd=CH_RND)
def churn_training_set(spark, sf_dir):
    """Whole training set (the cap belongs to the fit)."""
    return training_frame(spark, sf_dir).drop("rnd")


@register("churn_prediction_set", O.with_domain(*CH_PRED, body="SELECT * FROM pred"), money=CH_MONEY, rnd=CH_RND)
def churn_prediction_set(spark, sf_dir):
    d = dom(spark, sf_dir)
    return cf.churn_prediction_set(d.trx, d.cust, d.prog, P)


@register("capped_sample")
def capped_sample(spark, sf_dir):
    """The random cap as the feature: exactly 500 rows per firm drawn uniformly (reproducible key)."""
    d = dom(spark, sf_dir)
    return cf.churn_training_set(d.trx, d.cust, d.prog, P, max_rows=500).select(*CH_KEYS, "is_churn", "rnd")


@register("target_distribution", O.with_domain(*CH_TRAIN, body="""
SELECT is_churn, count(*) AS n_rows FROM train GROUP BY is_churn"""))
def target_distribution(spark, sf_dir):
    return training_frame(spark, sf_dir).groupBy("is_churn").agg(F.count(F.lit(1)).alias("n_rows"))


# ----------------------------------------------------------------- churn model
from ..operators import churn_model as cm  # noqa: E402

OUT_RND = {"q1": 4, "q3": 4, "outlier_ratio": 6}


def training_rows(spark, sf_dir):
    return training_frame(spark, sf_dir).drop("rnd")


@register("outlier_columns", O.with_domain(*CH_TRAIN, *O.outlier_ctes(), body="SELECT * FROM oflag"), rnd=OUT_RND)
def outlier_columns(spark, sf_dir):
    return cm.outlier_columns(training_rows(spark, sf_dir))


@register("winsorized_training", O.with_domain(*CH_TRAIN, *O.outlier_ctes(), body="SELECT * FROM wins"),
          rnd={c: 6 for c in cm.ROUND_COLS})
def winsorized_training(spark, sf_dir):
    t = training_rows(spark, sf_dir)
    w = cm.winsorize(t, cm.outlier_columns(t))
    return w.select("unique_customer_id", "program_id", "firm_id", "is_churn", *cm.ROUND_COLS)


@register("rounded_features", O.with_domain(*CH_PRED, body="SELECT firm_id, unique_customer_id, program_id, " + ", ".join(
    f"{O.round_even_int(c)} AS {c}" for c in cm.ROUND_COLS) + " FROM pred"))
def rounded_features(spark, sf_dir):
    d = dom(spark, sf_dir)
    pr = cf.churn_prediction_set(d.trx, d.cust, d.prog, P)
    return cm.round_features(pr).select(*CH_KEYS, *cm.ROUND_COLS)


@register("stratified_split", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, is_churn, n - cast(ceil(0.2 * n) AS BIGINT) AS n_train, cast(ceil(0.2 * n) AS BIGINT) AS n_val
FROM (SELECT firm_id, is_churn, count(*) AS n FROM train GROUP BY firm_id, is_churn) c"""))
def stratified_split(spark, sf_dir):
    s = cm.stratified_split(training_rows(spark, sf_dir), seed=P.seed)
    return s.groupBy("firm_id", "is_churn").agg(F.count_if(~F.col("is_val")).alias("n_train"),
                                                F.count_if(F.col("is_val")).alias("n_val"))


def scored_stand_in(spark, sf_dir):
    d = dom(spark, sf_dir)
    pr = cm.round_features(cf.churn_prediction_set(d.trx, d.cust, d.prog, P))
    return cm.postprocess(cm.stand_in_score(pr), P)


@register("risk_class", O.with_domain(*CH_PRED, O.scored_pred_cte(), body="""
SELECT firm_id, unique_customer_id, program_id, churn_prob, is_churn_label, churn_class FROM spred"""))
def risk_class(spark, sf_dir):
    return scored_stand_in(spark, sf_dir).select(*CH_KEYS, "churn_prob", "is_churn_label", "churn_class")


METRIC_RND = {"accuracy": 6, "precision": 6, "recall": 6, "f1_score": 6}


@register("confusion_metrics", O.with_domain(*CH_TRAIN, body=f"""
SELECT firm_id, tn, fp, fn, tp, (tp + tn) / (tp + tn + fp + fn) AS accuracy, prec AS precision, rec AS recall,
  CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END AS f1_score
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec
  FROM (SELECT firm_id,
    count(CASE WHEN is_churn <> 1 AND s < {P.validation_threshold} THEN 1 END) AS tn,
    count(CASE WHEN is_churn <> 1 AND s >= {P.validation_threshold} THEN 1 END) AS fp,
    count(CASE WHEN is_churn = 1 AND s < {P.validation_threshold} THEN 1 END) AS fn,
    count(CASE WHEN is_churn = 1 AND s >= {P.validation_threshold} THEN 1 END) AS tp
    FROM (SELECT *, {O.stand_in()} AS s FROM train) x GROUP BY firm_id) c) m"""), rnd=METRIC_RND)
def confusion_metrics(spark, sf_dir):
    t = cm.stand_in_score(training_rows(spark, sf_dir))
    return cm.binary_metrics(t, "is_churn", "churn_prob", P.validation_threshold)


@register("auc_rank", O.with_domain(*CH_TRAIN, body=f"""
SELECT firm_id, (sum(p * (st + (c + 1) / 2.0)) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * sum(c - p)) AS auc
FROM (SELECT firm_id, s, c, p, sum(c) OVER (PARTITION BY firm_id ORDER BY s ROWS UNBOUNDED PRECEDING) - c AS st
  FROM (SELECT firm_id, {O.stand_in()} AS s, count(*) AS c, count(CASE WHEN is_churn = 1 THEN 1 END) AS p
        FROM train GROUP BY firm_id, s) g) r
GROUP BY firm_id"""), rnd={"auc": 6})
def auc_rank(spark, sf_dir):
    return cm.auc(cm.stand_in_score(training_rows(spark, sf_dir)), "is_churn", "churn_prob")


@register("churn_summary", O.with_domain(*CH_PRED, O.scored_pred_cte(), body="""
SELECT firm_id, is_churn_label, churn_class, program_id, count(unique_customer_id) AS customer_count, """ + ", ".join(
    f"quantile_cont(cast({c} AS DOUBLE), 0.5) AS {c}" for c in cm.SUMMARY_COLS) + """
FROM spred GROUP BY firm_id, is_churn_label, churn_class, program_id"""), rnd={c: 4 for c in cm.SUMMARY_COLS})
def churn_summary(spark, sf_dir):
    return cm.churn_summary(scored_stand_in(spark, sf_dir))


@register("churn_risk_distribution", O.with_domain(*CH_PRED, O.scored_pred_cte(), body="""
SELECT firm_id, n_customers, n_low, n_medium, n_high, """ + ", ".join(
    f"CASE WHEN n_customers = 0 THEN NULL ELSE floor((2000 * n_{c} + n_customers) / (2 * n_customers)) / 10.0 END AS pct_{c}"
    for c in ("low", "medium", "high")) + """
FROM (SELECT firm_id, count(*) AS n_customers, count(CASE WHEN churn_class = 'low' THEN 1 END) AS n_low,
  count(CASE WHEN churn_class = 'medium' THEN 1 END) AS n_medium, count(CASE WHEN churn_class = 'high' THEN 1 END) AS n_high
  FROM spred GROUP BY firm_id) g"""))
def churn_risk_distribution(spark, sf_dir):
    return cm.risk_distribution(scored_stand_in(spark, sf_dir))


@register("revenue_at_risk", O.with_domain(*CH_PRED, O.scored_pred_cte(), body="""
SELECT firm_id, n_high, avg_spent_high, round(n_high * avg_spent_high, 2) AS revenue_at_risk
FROM (SELECT firm_id, count(CASE WHEN churn_class = 'high' THEN 1 END) AS n_high,
  avg(CASE WHEN churn_class = 'high' THEN cast(avg_spent AS DOUBLE) END) AS avg_spent_high
  FROM spred GROUP BY firm_id) g"""), rnd={"avg_spent_high": 6, "revenue_at_risk": 2})
def revenue_at_risk(spark, sf_dir):
    return cm.revenue_at_risk(scored_stand_in(spark, sf_dir))


_MODELS: dict = {}


def fitted(spark, sf_dir, max_iter=cm.MAX_ROUNDS):
    """Fit once per application and input folder; scores and importances share the model."""
    d = dom(spark, sf_dir)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), max_iter)
    if key not in _MODELS:
        raw = cf.churn_training_set(d.trx, d.cust, d.prog, P)
        stats = cm.fit_suppression(raw, P)
        train = cut_lineage(cm.prepare_training(raw, stats, P))
        _MODELS[key] = (cm.fit_churn(train, P, max_iter), train, stats)
    return d, _MODELS[key][0]


def fitted_scores(spark, sf_dir):
    """The prediction set scored by the fitted model."""
    d, model = fitted(spark, sf_dir)
    stats = _MODELS[(spark.sparkContext.applicationId, os.path.abspath(sf_dir), cm.MAX_ROUNDS)][2]
    pred = cm.model_inputs(cf.churn_prediction_set(d.trx, d.cust, d.prog, P), stats)
    return cm.postprocess(cm.shown_values(cm.churn_probability(model, pred)), P)


def fitted_training(spark, sf_dir, max_iter=cm.MAX_ROUNDS):
    fitted(spark, sf_dir, max_iter)
    return _MODELS[(spark.sparkContext.applicationId, os.path.abspath(sf_dir), max_iter)][1]


@register("churn_scores")
def churn_scores(spark, sf_dir):
    """Fitted gradient-boosted model applied to the prediction set (rows-only check)."""
    return fitted_scores(spark, sf_dir).select(*CH_KEYS, "churn_prob", "is_churn_pred", "is_churn_label", "churn_class", "model_id")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    return cm.feature_importances(model, spark, P.run_id)


# ----------------------------------------------------------------- firm KPIs and narrative
from ..operators import insight as ins  # noqa: E402
from ..sources import registry as reg  # noqa: E402

KPI = [*SEG, O.analytic_customer_cte(), *O.kpi_ctes(P)]
MED_NAMES = list(ins.MEDIAN_CODES)
KPI_MONEY = MED_NAMES + ["lost_revenue_from_churn_risk", "projected_revenue_from_active_customers"]


def ac_frame(spark, sf_dir):
    return cust_plan.analytic_customer(seg_rows(spark, sf_dir), P)


TOTAL_COLS = ["firm_id", "earliest_trn_year", "earliest_trn_month", "total_customers", "total_vip_customer_count",
              "total_vip_customer_pct", "total_loyal_customer_count", "total_loyal_customer_pct",
              "total_one_time_customer_count", "total_one_time_customer_pct"]


@register("firm_totals", O.with_domain(*KPI, body=f"SELECT {', '.join(TOTAL_COLS)} FROM ktot"))
def firm_totals(spark, sf_dir):
    return ins.firm_totals(ac_frame(spark, sf_dir)).select(*TOTAL_COLS)


LY_COLS = ["firm_id", "customer_count"] + [f"{n}_{s}" for n, _, _ in O.LY_COUNTS for s in ("count", "pct")]


@register("firm_last_year", O.with_domain(*KPI, body=f"SELECT {', '.join(LY_COLS)} FROM kly"))
def firm_last_year(spark, sf_dir):
    return ins.firm_last_year(ac_frame(spark, sf_dir), P).select(*LY_COLS)


@register("firm_medians", O.with_domain(*KPI, body=f"SELECT firm_id, {', '.join(MED_NAMES)} FROM kly"),
          money=MED_NAMES)
def firm_medians(spark, sf_dir):
    return ins.firm_medians(ac_frame(spark, sf_dir), P)


def kpi_frame(spark, sf_dir):
    return ins.firm_kpis(ac_frame(spark, sf_dir), P)


@register("firm_kpis", O.with_domain(*KPI, body="SELECT * FROM kpis"), money=KPI_MONEY)
def firm_kpis(spark, sf_dir):
    return kpi_frame(spark, sf_dir)


DERIVED = ["churned_customer_count", "total_churn_risk_customer_pct", "actual_churn_rate", "median_monetary_value_int",
           "median_avg_purchase_value_int", "lost_revenue_int", "projected_revenue_int",
           "new_customer_contribution_pct_1", "retention_ratio_1"]


@register("firm_kpi_derived", O.with_domain(*KPI, body=f"SELECT firm_id, {', '.join(DERIVED)} FROM kder"))
def firm_kpi_derived(spark, sf_dir):
    return ins.derive_kpis(kpi_frame(spark, sf_dir)).select("firm_id", *DERIVED)


RULES = ["rule_retention", "rule_vip", "rule_conversion", "rule_growth"]


@register("insight_rules", O.with_domain(*KPI, body=f"SELECT firm_id, {', '.join(RULES)} FROM krules"))
def insight_rules(spark, sf_dir):
    return ins.insight_rules(ins.derive_kpis(kpi_frame(spark, sf_dir))).select("firm_id", *RULES)


def insight_frame(spark, sf_dir):
    d = dom(spark, sf_dir)
    ac = cust_plan.analytic_customer(cust_plan.segmented_rows(d, P), P)
    return ins.firm_insight(ac, reg.tenants(d.cust), P)


@register("insight_text", O.with_domain(*KPI, body=f"""
SELECT firm_id, {O.insight_sql_expr()} AS smart_insight
FROM (SELECT *, concat('FIRM_', cast(firm_id AS VARCHAR)) AS firm_name FROM krules) k"""))
def insight_text(spark, sf_dir):
    return insight_frame(spark, sf_dir).select("firm_id", "smart_insight")


def _segment_text_sql():
    sent = O.fill_sql(ins.T_SEGMENT_SENTENCE, segment="segment_name", count=O.thousands_sql("n"),
                      monetary="concat(" + O.thousands_sql("mon_int") + ", '.0')",
                      frequency="printf('%d.%02d', frq100 // 100, frq100 % 100)")
    return f"""
SELECT firm_id, string_agg(sentence, ' ' ORDER BY segment_name) AS segment_insight FROM (
  SELECT firm_id, segment_name, {sent} AS sentence FROM (
    SELECT firm_id, segment_name, n,
      cast(sign(mon) * floor((abs(mon) * 2 + n) / (n * 2)) AS BIGINT) AS mon_int,
      cast(floor((frq * 200 + n) / (n * 2)) AS BIGINT) AS frq100
    FROM (SELECT firm_id, P15 AS segment_name, count(*) AS n, sum(cast(P5 AS DECIMAL(38,2))) AS mon,
            sum(cast(P4 AS BIGINT)) AS frq FROM ac GROUP BY firm_id, P15) g) s) t
GROUP BY firm_id"""


@register("segment_text", O.with_domain(*SEG, O.analytic_customer_cte(), body=_segment_text_sql()))
def segment_text(spark, sf_dir):
    return ins.segment_text(ac_frame(spark, sf_dir))


# ----------------------------------------------------------------- registry, sinks, run log
from ..operators import sinks  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import registry as reg  # noqa: E402
from ..streaming import incremental as inc  # noqa: E402


@register("tenant_registry", O.with_domain(body="""
SELECT DISTINCT cast(firm_id AS INTEGER) AS "ID", concat('FIRM_', cast(firm_id AS VARCHAR)) AS "FIRM_NAME",
  concat('T', cast(firm_id AS VARCHAR), '_ELT') AS "CONN_DATA_USER_ELT",
  concat('T', cast(firm_id AS VARCHAR), '_CDP') AS "CONN_DATA_USER_CDP" FROM cust"""))
def tenant_registry(spark, sf_dir):
    return reg.tenants(dom(spark, sf_dir).cust)


def _metrics_values():
    return ", ".join(f"({m}, '{n}', {p})" for m, n, p in reg.METRICS)


@register("tenant_task_matrix", O.with_domain(body=f"""
SELECT a.firm_id, m.metric_id, m.display_name, m.working_day_period
FROM (SELECT DISTINCT c.firm_id FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
      WHERE t.transaction_date >= {O.ts(P.months_back(12))}) a
CROSS JOIN (SELECT * FROM (VALUES {_metrics_values()}) v(metric_id, display_name, working_day_period)
            WHERE working_day_period > 0) m"""))
def tenant_task_matrix(spark, sf_dir):
    d = dom(spark, sf_dir)
    return reg.task_matrix(d.trx, d.cust, P)


@register("parquet_roundtrip", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, count(*) AS n_rows, sum(monetary) AS monetary, cast(sum(frequency) AS BIGINT) AS frequency
FROM rfm GROUP BY firm_id"""), money=["monetary"])
def parquet_roundtrip(spark, sf_dir):
    """RFM rows written to Parquet (partitioned by tenant) under the shared folder and read back."""
    path = scratch_path(spark, "rfm_stg")
    sinks.write_parquet(rfm_frame(spark, sf_dir), path)
    back = spark.read.parquet(path).withColumn("firm_id", F.col("firm_id").cast("long"))
    return back.groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("monetary").alias("monetary"),
                                       F.sum("frequency").alias("frequency"))


@register("overwrite_sink", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, count(*) AS n_rows FROM rfm WHERE firm_id <> 1 OR frequency_iade > 0 GROUP BY firm_id"""))
def overwrite_sink(spark, sf_dir):
    """Full write, then a rebuild of tenant 1 only (dynamic partition overwrite)."""
    path = scratch_path(spark, "rfm_rebuild")
    r = rfm_frame(spark, sf_dir)
    sinks.write_parquet(r, path)
    sinks.rebuild_tenants(r.where((F.col("firm_id") == 1) & (F.col("frequency_iade") > 0)), path)
    back = spark.read.parquet(path).withColumn("firm_id", F.col("firm_id").cast("long"))
    return back.groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("schema_aligned_append", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, count(*) AS n_rows, count(frequency) AS n_frequency, sum(monetary) AS monetary
FROM (SELECT firm_id, unique_customer_id, kart_tip_detay, monetary, frequency FROM rfm
      UNION ALL SELECT firm_id, unique_customer_id, kart_tip_detay, monetary, NULL FROM rfm WHERE recency_iade IS NOT NULL) u
GROUP BY firm_id"""), money=["monetary"])
def schema_aligned_append(spark, sf_dir):
    """Append frames with extra and missing columns to a fixed target schema."""
    path = scratch_path(spark, "rfm_target")
    r = rfm_frame(spark, sf_dir)
    r.select("firm_id", "unique_customer_id", "kart_tip_detay", "monetary", "frequency").limit(0) \
        .write.mode("overwrite").parquet(path)
    sinks.append_aligned(r, path)  # extra columns dropped
    sinks.append_aligned(r.where(F.col("recency_iade").isNotNull())
                         .select("unique_customer_id", "monetary", "firm_id", "kart_tip_detay", "recency"), path)
    back = spark.read.parquet(path)
    return back.groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count("frequency").alias("n_frequency"),
                                       F.sum("monetary").alias("monetary"))


@register("catalog_append", O.with_domain(O.rfm_cte(), body="""
SELECT firm_id, count(*) AS n_rows, count(frequency) AS n_frequency, sum(monetary) AS monetary
FROM (SELECT firm_id, monetary, frequency FROM rfm
      UNION ALL SELECT firm_id, monetary, NULL FROM rfm WHERE recency_iade IS NOT NULL) u
GROUP BY firm_id"""), money=["monetary"])
def catalog_append(spark, sf_dir):
    """A catalog table published twice (the second version replaces the first whole), then appended to by name:
    columns in another order, one too many, one missing."""
    table, folder = f"rfm_published_{uuid.uuid4().hex[:8]}", scratch_path(spark, "published")
    r = rfm_frame(spark, sf_dir).select("unique_customer_id", "kart_tip_detay", "monetary", "frequency", "recency_iade", "firm_id")
    sinks.publish(r.drop("recency_iade").where("firm_id = 1"), table, folder)
    sinks.publish(r.drop("recency_iade"), table, folder)
    sinks.append_to_table(r.where(F.col("recency_iade").isNotNull()).select(
        "firm_id", "monetary", "recency_iade", "kart_tip_detay", "unique_customer_id"), table)
    out = cut_lineage(spark.table(table).groupBy(F.col("firm_id").cast("long").alias("firm_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("frequency").alias("n_frequency"), F.sum("monetary").alias("monetary")))
    spark.sql(f"DROP TABLE {table}")
    return out


@register("tenant_task_table", O.with_domain(body=f"""
SELECT m.firm_id, m.metric_id, m.display_name, m.working_day_period
FROM (SELECT DISTINCT firm_id, unnest([{reg.RFM_CLV}, {reg.CHURN}]) AS metric_id, 'M' || firm_id AS display_name,
             cast(30 * firm_id - 30 AS INTEGER) AS working_day_period FROM cust) m
WHERE working_day_period > 0 AND firm_id IN (
  SELECT c.firm_id FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
  WHERE t.transaction_date >= {O.ts(P.months_back(12))})"""))
def tenant_task_table(spark, sf_dir):
    """Tasks from a table of modules per tenant: active tenants, modules with a positive period."""
    d = dom(spark, sf_dir)
    f = F.col("firm_id")
    metrics = d.cust.select("firm_id").distinct().select(
        f, F.explode(F.array(F.lit(reg.RFM_CLV), F.lit(reg.CHURN))).alias("metric_id"),
        F.concat(F.lit("M"), f.cast("string")).alias("display_name"), (f * 30 - 30).cast("int").alias("working_day_period"))
    return reg.tasks_of(metrics, d.trx, d.cust, P)


@register("parameterized_query", O.with_domain(body=f"""
SELECT trx_state_id, count(*) AS n_rows FROM valid
WHERE transaction_date >= {O.ts(P.churn_cutoff)} AND amount_after_discount > {P.min_spend}
GROUP BY trx_state_id"""))
def parameterized_query(spark, sf_dir):
    """Named parameters bound by ``spark.sql(args=...)`` (no text substitution)."""
    t = rfm_ops.valid_transactions(dom(spark, sf_dir).trx)
    return spark.sql(
        "SELECT trx_state_id, count(*) AS n_rows FROM {t} "
        "WHERE transaction_date >= :cutoff AND amount_after_discount > :min_spend GROUP BY trx_state_id",
        args={"cutoff": P.churn_cutoff.strftime("%Y-%m-%d %H:%M:%S"), "min_spend": P.min_spend}, t=t)


@register("audit_columns", O.with_domain(O.rfm_cte(), body=f"""
SELECT firm_id, unique_customer_id, kart_tip_detay, '{P.created_by}' AS created_by, '{P.created_by}' AS updated_by,
  {O.audit_ts(P)} AS create_date, {O.audit_ts(P)} AS update_date, cast({P.run_id} AS BIGINT) AS model_id
FROM rfm"""))
def audit_columns(spark, sf_dir):
    r = rfm_frame(spark, sf_dir).select("firm_id", "unique_customer_id", "kart_tip_detay")
    return sinks.with_audit(r, P.created_by, P.audit_ts_col, P.run_id)


def _run_log_sql():
    metrics = "[" + ", ".join(str(m) for m, _, _ in reg.METRICS) + "]"
    jt = " ".join(f"WHEN {k} THEN '{v}'" for k, v in reg.JOB_TYPES.items())
    return f"""
SELECT firm_id, metric_id, status, job_type, last_ts, n_events FROM (
  SELECT *, row_number() OVER (PARTITION BY firm_id, metric_id ORDER BY ts DESC, event_id DESC) AS rn,
    max(ts) OVER (PARTITION BY firm_id, metric_id) AS last_ts,
    count(*) OVER (PARTITION BY firm_id, metric_id) AS n_events
  FROM (SELECT event_id, ts, user_id % 3 + 1 AS firm_id, {metrics}[cast(event_id % 3 + 1 AS INTEGER)] AS metric_id,
          CASE {metrics}[cast(event_id % 3 + 1 AS INTEGER)] {jt} END AS job_type,
          CASE WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'PENDING' END AS status
        FROM events) e) r
WHERE rn = 1"""


@register("run_log_latest", _run_log_sql())
def run_log_latest(spark, sf_dir):
    log = sinks.validate_status(reg.run_log_events(spark, sf_dir))
    return sinks.latest_status(log)


UPSERT_COLS = ["kart_tip_detay", "monetary", "frequency", "recency"]


@register("customer_upsert", O.with_domain(O.rfm_cte(), body=f"""
SELECT coalesce(n.firm_id, o.firm_id) AS firm_id, coalesce(n.unique_customer_id, o.unique_customer_id) AS unique_customer_id, """ + ", ".join(
    f"CASE WHEN n.unique_customer_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in UPSERT_COLS) + """
FROM (SELECT firm_id, unique_customer_id, min(kart_tip_detay) AS kart_tip_detay, arg_min(monetary, kart_tip_detay) AS monetary,
        arg_min(frequency, kart_tip_detay) AS frequency, arg_min(recency, kart_tip_detay) AS recency
      FROM rfm WHERE firm_id % 3 <> 0 GROUP BY firm_id, unique_customer_id) o
FULL OUTER JOIN (SELECT firm_id, unique_customer_id, max(kart_tip_detay) AS kart_tip_detay,
        arg_max(monetary, kart_tip_detay) AS monetary, arg_max(frequency, kart_tip_detay) AS frequency,
        arg_max(recency, kart_tip_detay) AS recency
      FROM rfm WHERE firm_id % 3 <> 1 GROUP BY firm_id, unique_customer_id) n
ON o.firm_id = n.firm_id AND o.unique_customer_id = n.unique_customer_id"""), money=["monetary"])
def customer_upsert(spark, sf_dir):
    """Upsert on the firm's unique customer: an earlier load (two firms of three, first program), as a table, and a
    newer one (two of three, last program), every firm in one or both; overlapping customers take the newer row.
    Only the newer load's firms are read and rewritten."""
    r = rfm_frame(spark, sf_dir)
    keys = ["firm_id", "unique_customer_id"]
    old = reshape.collapse_first(r.where(F.col("firm_id") % 3 != 0), keys, "kart_tip_detay", UPSERT_COLS[1:])
    last = F.max_by(F.struct(*[F.col(c) for c in UPSERT_COLS]), F.col("kart_tip_detay")).alias("_r")
    new = r.where(F.col("firm_id") % 3 != 1).groupBy(*keys).agg(last) \
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in UPSERT_COLS])
    path = scratch_path(spark, "customers")
    sinks.write_parquet(old, path)
    sinks.upsert_partitions(new, path, keys)
    return spark.read.schema(old.schema).parquet(path).select(*keys, *UPSERT_COLS)


@register("incremental_totals", O.with_domain(body="""
SELECT c.firm_id, c.unique_customer_id, count(*) AS n_transactions, sum(t.amount_after_discount) AS spend,
  min(t.transaction_date) AS first_date, max(t.transaction_date) AS last_date
FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id GROUP BY c.firm_id, c.unique_customer_id"""),
          money=["spend"])
def incremental_totals(spark, sf_dir):
    """Structured Streaming: line items arrive in two drops, part of them twice; the running totals count each once."""
    return streamed(spark, sf_dir).totals()


_STREAMS: dict = {}


def streamed(spark, sf_dir):
    """Stored partials of a stream over all line items, made once per application and input folder.

    The second drop repeats the lines of every third order, most of which the first brought already.
    """
    from ..sources.domain import customers, raw

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _STREAMS:
        landing, out = scratch_path(spark, "landing"), scratch_path(spark, "incremental")
        lines = raw(spark, sf_dir, "lineitem").select(*inc.LINE_COLS)
        orders = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
        order = F.col("l_orderkey")
        drops = [lines.where(order % 5 < 3), lines.where(order % 5 >= 3).unionByName(lines.where(order % 3 == 0))]
        # as many files as tasks (a task writes and reads one), in two batches a drop
        files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
        for k, drop in enumerate(drops):
            drop.repartitionByRange(files, "l_orderkey").write.parquet(os.path.join(landing, f"drop={k}"))
            store = inc.run_incremental(spark, landing, lines.schema, inc.order_lookup(orders), customers(spark, sf_dir), out,
                                        max_files_per_trigger=-(-files // 2), compact_every=2, mapped=inc.MAPPED_COLS)
        _STREAMS[key] = store
    return _STREAMS[key]


@register("incremental_medians", O.with_domain(body="""
SELECT firm_id, count(*) AS n, true AS within_bound FROM valid WHERE amount_after_discount IS NOT NULL GROUP BY firm_id"""))
def incremental_medians(spark, sf_dir):
    """Median basket per firm from the stream's merged sketches; its exact rank lies within the stated bound."""
    medians = streamed(spark, sf_dir).basket_medians()
    valid = rfm_ops.valid_transactions(dom(spark, sf_dir).trx)
    errors = sketches.rank_errors(valid, ["firm_id"], "amount_after_discount", medians, {"median_basket": 0.5})
    return medians.join(errors.select("firm_id", F.col("median_basket").alias("error")), "firm_id").select(
        "firm_id", "n", (F.col("error") <= sketches.RANK_BOUND).alias("within_bound"))


def _firm_p_codes_sql():
    cols = []
    for name, code in ins.FIRM_P_CODES.items():
        n = name.lower()
        src = {"retention_ratio": "retention_ratio_1", "smart_insight": "smart_insight"}.get(n, n)
        cols.append(f"cast({src} AS VARCHAR) AS {code}")
    return f"""
SELECT firm_id, {', '.join(cols)}, '{P.created_by}' AS created_by, '{P.created_by}' AS updated_by,
  {O.audit_ts(P)} AS create_date, {O.audit_ts(P)} AS update_date
FROM (SELECT *, {O.insight_sql_expr()} AS smart_insight
      FROM (SELECT *, concat('FIRM_', cast(firm_id AS VARCHAR)) AS firm_name FROM krules) k) i"""


@register("firm_p_codes", O.with_domain(*KPI, body=_firm_p_codes_sql()))
def firm_p_codes(spark, sf_dir):
    """Dictionary-driven rename of the firm KPI row (with the narrative) to P-codes."""
    d = dom(spark, sf_dir)
    ac = cust_plan.analytic_customer(cust_plan.segmented_rows(d, P), P)
    return ins.firm_based(ac, reg.tenants(d.cust), ins.definitions(spark), P)


CHURN_CODES = list(reshape.CHURN_P_CODES.values())
AUDIT_SQL = (f"'{P.created_by}' AS created_by, '{P.created_by}' AS updated_by, {O.audit_ts(P)} AS create_date, "
             f"{O.audit_ts(P)} AS update_date")


@register("churn_p_codes", O.with_domain(*CH_PRED, O.scored_pred_cte(), O.churn_p_codes_cte(), body=f"""
SELECT firm_id, unique_customer_id, {', '.join(CHURN_CODES)}, {AUDIT_SQL} FROM acc"""))
def churn_p_codes(spark, sf_dir):
    """Churn part of ANALYTIC_CUSTOMER from the scored prediction set (deterministic stand-in score)."""
    return cust_plan.churn_p_codes(scored_stand_in(spark, sf_dir), P)


def _full_sql():
    all_codes = sorted(AC_CODES + CHURN_CODES, key=lambda c: int(c[1:]))
    sel = ", ".join(all_codes)
    return O.with_domain(*SEG, O.analytic_customer_cte(), *CH_PRED, O.scored_pred_cte(), O.churn_p_codes_cte(),
                         body=f"""
SELECT coalesce(s.firm_id, c.firm_id) AS firm_id, coalesce(s.unique_customer_id, c.unique_customer_id)
  AS unique_customer_id, {sel}
FROM ac s FULL OUTER JOIN (SELECT firm_id AS c_firm, unique_customer_id AS c_uid, {', '.join(CHURN_CODES)} FROM acc) c
  ON s.firm_id = c.c_firm AND s.unique_customer_id = c.c_uid""".replace("c.firm_id", "c.c_firm")
                         .replace("c.unique_customer_id", "c.c_uid"))


@register("analytic_customer_full", _full_sql())
def analytic_customer_full(spark, sf_dir):
    """One ANALYTIC_CUSTOMER row per customer with segment and churn codes merged."""
    seg_part = cust_plan.analytic_customer(seg_rows(spark, sf_dir), P)
    churn_part = cust_plan.churn_p_codes(scored_stand_in(spark, sf_dir), P)
    return cust_plan.merge_customer_parts(seg_part, churn_part)


@register("churn_model_metrics")
def churn_model_metrics(spark, sf_dir):
    """CHURN_PERFORMANCE_METRICS of the fitted model: confusion cells, accuracy, precision,
    recall, F1 and AUC per firm on the validation rows (rows-only check)."""
    from .runs import churn_performance

    _, model = fitted(spark, sf_dir)
    val = cm.churn_probability(model, fitted_training(spark, sf_dir).where(F.col("is_val")))
    return churn_performance(val, P, P.run_id)


@register("churn_firm_summary")
def churn_firm_summary(spark, sf_dir):
    """CHURN_FIRM_BASED of the fitted model's scores (rows-only check)."""
    return cm.churn_summary(fitted_scores(spark, sf_dir))


@register("capped_sample_size", O.with_domain(*CH_TRAIN, body="""
SELECT 'n_rows' AS metric, cast(least(500, count(*)) AS BIGINT) AS value FROM train
UNION ALL SELECT 'n_candidates' AS metric, cast(count(*) AS BIGINT) AS value FROM train"""))
def capped_sample_size(spark, sf_dir):
    """The random cap without tenants draws exactly min(n, rows) rows (n = 500) out of all candidates."""
    d = dom(spark, sf_dir)
    ds = cf.training_filter(cf.churn_dataset(d.trx, d.cust, d.prog, P), P)
    sample = cf.capped_sample(ds, 500, P.seed, keys=())
    return (sample.agg(F.lit("n_rows").alias("metric"), F.count(F.lit(1)).alias("value"))
            .unionByName(ds.agg(F.lit("n_candidates").alias("metric"), F.count(F.lit(1)).alias("value"))))


@register("capped_sample_per_firm", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, cast(least(20, count(*)) AS BIGINT) AS n_rows, cast(count(*) AS BIGINT) AS n_candidates
FROM train GROUP BY firm_id"""))
def capped_sample_per_firm(spark, sf_dir):
    """The cap of the fit: exactly min(n, rows) rows of every firm (n = 20 here)."""
    d = dom(spark, sf_dir)
    ds = cf.training_filter(cf.churn_dataset(d.trx, d.cust, d.prog, P), P)
    drawn = cf.capped_sample(ds, 20, P.seed).groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return drawn.join(ds.groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_candidates")), "firm_id")


# ----------------------------------------------------------------- tenants with colliding ids, own thresholds
from ..sources.domain import colliding  # noqa: E402

#: Ids counted anew within each firm, as ``sources.domain.colliding`` does.
WITHIN = "* REPLACE (cast(unique_customer_id // 6 * 2 AS BIGINT) AS unique_customer_id)"


@register("tenant_isolation_rfm", O.with_domain(O.rfm_cte(), body=f"SELECT {WITHIN} FROM rfm"),
          money=RFM_MONEY, rnd={c: 4 for c in RATIO_COLS})
def tenant_isolation_rfm(spark, sf_dir):
    """RFM where customers of different firms share their ids: each firm's own result."""
    d = colliding(dom(spark, sf_dir))
    return rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, P)


@register("tenant_isolation_profile", O.with_domain(O.rfm_cte(), O.profile_cte(), O.all_data_cte(),
                                                    body=f"SELECT {WITHIN} FROM all_data"),
          money=PROFILE_MONEY + RFM_MONEY, rnd={**{c: 6 for c in PROFILE_DOUBLES}, **{c: 4 for c in RATIO_COLS}})
def tenant_isolation_profile(spark, sf_dir):
    """Profile and RFM joined where customers of different firms share their ids."""
    d = colliding(dom(spark, sf_dir))
    return cust_plan.segmentation_input(d, P)


@register("tenant_isolation_churn", O.with_domain(*CH_TRAIN, body=f"SELECT {WITHIN} FROM ds"), money=CH_MONEY, rnd=CH_RND)
def tenant_isolation_churn(spark, sf_dir):
    """Churn features, gaps and labels where customers of different firms share their ids."""
    d = colliding(dom(spark, sf_dir))
    return cf.churn_dataset(d.trx, d.cust, d.prog, P)


def _label_by_firm_sql():
    return O.with_domain("""th AS (
  SELECT DISTINCT firm_id, cast(60 + 60 * firm_id AS INTEGER) AS days FROM cust
)""", f"""x AS (
  SELECT t.*, c.unique_customer_id, c.is_deleted AS gone, th.days, {O.ts(P.as_of)} - to_days(th.days) AS cutoff
  FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id JOIN th ON t.firm_id = th.firm_id
)""", f"""b AS (
  SELECT firm_id, unique_customer_id, program_id, days, cutoff, max(transaction_date) AS last FROM x
  WHERE gone = 0 AND amount_after_discount IS NOT NULL AND transaction_date < cutoff
  GROUP BY firm_id, unique_customer_id, program_id, days, cutoff
  HAVING count(transaction_id) > {P.churn_min_transactions} AND sum(amount_after_discount) > {P.churn_min_spend}
)""", """a AS (
  SELECT firm_id, unique_customer_id, program_id, count(transaction_id) AS n FROM x WHERE transaction_date >= cutoff
  GROUP BY firm_id, unique_customer_id, program_id
)""", body=f"""
SELECT firm_id, unique_customer_id, program_id, coalesce(n, 0) AS transactions_after_cutoff,
  CASE WHEN coalesce(n, 0) = 0 THEN 1 ELSE 0 END AS is_churn, {O.fdays('cutoff', 'last')} AS days_since_last_transaction,
  coalesce(n, 0) > 0 OR {O.fdays('cutoff', 'last')} <= days AS in_training
FROM b LEFT JOIN a USING (firm_id, unique_customer_id, program_id)""")


@register("churn_label_by_firm", _label_by_firm_sql(), rnd={"days_since_last_transaction": 6})
def churn_label_by_firm(spark, sf_dir):
    """Labels where each firm has its own threshold (120, 180 and 240 days), and who enters the training."""
    d = dom(spark, sf_dir)
    own = d.cust.select("firm_id").distinct().withColumn("churn_threshold", F.lit(60) + F.lit(60) * F.col("firm_id"))
    ds = cut_lineage(cf.churn_dataset(d.trx, d.cust, d.prog, P, own))
    kept = cf.training_filter(ds, P, own).select(*CH_KEYS, F.lit(True).alias("in_training"))
    return ds.join(kept, CH_KEYS, "left").select(
        *CH_KEYS, "transactions_after_cutoff", "is_churn", "days_since_last_transaction",
        F.coalesce("in_training", F.lit(False)).alias("in_training"))


@register("suppressed_prediction", O.with_domain(
    *CH_TRAIN, *O.churn_ctes(P, "predict", "_p"), *O.outlier_ctes(keys=("firm_id", "program_id"), rows="pred"),
    body="SELECT * EXCLUDE (is_churn) FROM wins"), rnd={c: 6 for c in cm.ROUND_COLS})
def suppressed_prediction(spark, sf_dir):
    """Prediction rows under the suppression statistics of the training rows, per firm and program."""
    d = dom(spark, sf_dir)
    stats = cm.fit_suppression(training_rows(spark, sf_dir), P)
    w = cm.suppress(cf.churn_prediction_set(d.trx, d.cust, d.prog, P), stats, cm.FIT_KEYS)
    return w.select(*CH_KEYS, *cm.ROUND_COLS)


# ----------------------------------------------------------------- the fitted model by exact invariants
@register("churn_scores_invariants", O.with_domain(*CH_PRED, body="""
SELECT firm_id, count(*) AS n_rows, count(*) AS n_in_range, count(*) AS n_label_ok, count(*) AS n_class_ok
FROM pred GROUP BY firm_id"""))
def churn_scores_invariants(spark, sf_dir):
    """Fitted scores per firm: as many as prediction rows, all within [0, 1], labels and classes that follow from them."""
    p = F.col("churn_prob")
    label = F.when(p >= P.score_threshold, cm.LABEL_CHURN).otherwise(cm.LABEL_NO_RISK)
    return fitted_scores(spark, sf_dir).groupBy("firm_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(p.between(0, 1)).alias("n_in_range"),
        F.count_if(F.col("is_churn_label") == label).alias("n_label_ok"),
        F.count_if(F.col("churn_class") == F.when(p < P.risk_medium, "low").when(p < P.risk_high, "medium")
                   .otherwise("high")).alias("n_class_ok"))


@register("churn_metrics_invariants", O.with_domain(*CH_TRAIN, body="""
SELECT firm_id, sum(cast(ceil(0.2 * n) AS BIGINT))::BIGINT AS n_validated, sum(CASE WHEN is_churn = 1 THEN cast(ceil(0.2 * n) AS BIGINT) ELSE 0 END)::BIGINT AS n_churned,
  true AS auc_in_range
FROM (SELECT firm_id, is_churn, count(*) AS n FROM train GROUP BY firm_id, is_churn) c GROUP BY firm_id"""))
def churn_metrics_invariants(spark, sf_dir):
    """Validation metrics per firm: the confusion cells count every validation row, by its class."""
    m = churn_model_metrics(spark, sf_dir)
    return m.select("firm_id", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_validated"),
                    (F.col("fn") + F.col("tp")).alias("n_churned"),
                    F.coalesce(F.col("auc").between(0, 1), F.lit(True)).alias("auc_in_range"))


@register("importance_invariants", "SELECT unnest([" + ", ".join(f"'{c}'" for c in cm.MODEL_FEATURES + cm.CATEGORICAL)
          + "]) AS feature, true AS in_range, true AS sums_to_one FROM (SELECT count(*) FROM lineitem) x")
def importance_invariants(spark, sf_dir):
    """Importances: a row for every model input, within [0, 1], that sum to 1."""
    imp = feature_importance(spark, sf_dir)
    row = F.struct("feature", F.col("importance").between(0, 1).alias("in_range"))  # a row per model input
    return (imp.agg(F.collect_list(row).alias("rows"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
            .select(F.inline("rows"), "sums_to_one"))


# ----------------------------------------------------------------- tables read back from runs
_RUNS: dict = {}


def two_runs(spark, sf_dir):
    """Tables of two runs into one folder, made once per application and input folder: all
    tenants' segmentation and insight, then segmentation without firm 2."""
    from .runs import run_tasks

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _RUNS:
        d, out = dom(spark, sf_dir), scratch_path(spark, "runs")
        tasks = reg.task_matrix(d.trx, d.cust, P).where(F.col("metric_id") != reg.CHURN)
        first = run_tasks(spark, d, out, P, tasks=tasks)
        again = run_tasks(spark, d, out, P, tasks=tasks.where((F.col("metric_id") == reg.RFM_CLV) & (F.col("firm_id") != 2)))
        _RUNS[key] = first | again
    return _RUNS[key]


def run_table(spark, sf_dir, name):
    df = spark.read.parquet(two_runs(spark, sf_dir)[name])
    return df.withColumn("firm_id", F.col("firm_id").cast("long"))


@register("run_firm_based", O.with_domain(*KPI, body=_firm_p_codes_sql()))
def run_firm_based(spark, sf_dir):
    """ANALYTIC_FIRM_BASED as the run leaves it."""
    return run_table(spark, sf_dir, "ANALYTIC_FIRM_BASED")


@register("run_log", O.with_domain(body=f"""
SELECT firm_id, metric_id, status, count(*) AS n_events FROM (
  SELECT firm_id, metric_id, unnest(['PENDING', 'SUCCESS']) AS status FROM (
    SELECT DISTINCT t.firm_id, m.metric_id, r.run FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id,
      (SELECT unnest([{reg.RFM_CLV}, {reg.SMART_INSIGHT}]) AS metric_id) m, (SELECT unnest([1, 2]) AS run) r
    WHERE t.transaction_date >= {O.ts(P.months_back(12))} AND (r.run = 1 OR (m.metric_id = {reg.RFM_CLV} AND t.firm_id <> 2))) e) s
GROUP BY firm_id, metric_id, status"""))
def run_log(spark, sf_dir):
    """STG_LOGS after two runs: a PENDING and a SUCCESS event per task and run."""
    return run_table(spark, sf_dir, "STG_LOGS").groupBy("firm_id", "metric_id", "status").agg(
        F.count(F.lit(1)).alias("n_events"))


@register("run_rebuild", O.with_domain(O.rfm_cte(), O.profile_cte(), O.all_data_cte(), body="""
SELECT firm_id, count(*) AS n_rows FROM all_data WHERE firm_id <> 2 GROUP BY firm_id"""))
def run_rebuild(spark, sf_dir):
    """ANALYTIC_ALL_DATA after a rebuild without firm 2: its rows are gone."""
    return run_table(spark, sf_dir, "ANALYTIC_ALL_DATA").groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("run_rerun", O.with_domain(*SEG, O.analytic_customer_cte(), *CH_PRED, O.scored_pred_cte(), O.churn_p_codes_cte(), body=f"""
SELECT 'CHURN_FEATURE_IMPORTANCES' AS table_name, firm_id, cast({len(cm.MODEL_FEATURES + cm.CATEGORICAL)} AS BIGINT) AS n_rows
FROM (SELECT DISTINCT firm_id FROM cust) f
UNION ALL SELECT 'CHURN_PERFORMANCE_METRICS', firm_id, 1 FROM (SELECT DISTINCT firm_id FROM cust) f
UNION ALL SELECT 'ANALYTIC_CUSTOMER', firm_id, count(*) FROM (
  SELECT firm_id, unique_customer_id FROM ac UNION SELECT firm_id, unique_customer_id FROM acc) c GROUP BY firm_id"""))
def run_rerun(spark, sf_dir):
    """Rows per firm after the same run was done twice into one folder: none stands there twice."""
    from .runs import run_tasks

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), "rerun")
    if key not in _RUNS:  # made once per application and input folder
        d, out = dom(spark, sf_dir), scratch_path(spark, "rerun")
        tasks = reg.task_matrix(d.trx, d.cust, P).where(F.col("metric_id") != reg.SMART_INSIGHT)
        for _ in range(2):
            _RUNS[key] = run_tasks(spark, d, out, P, max_iter=2, tasks=tasks)
    paths = _RUNS[key]
    parts = [spark.read.parquet(paths[t]).groupBy(F.col("firm_id").cast("long").alias("firm_id")).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "firm_id", "n_rows")
             for t in ("CHURN_FEATURE_IMPORTANCES", "CHURN_PERFORMANCE_METRICS", "ANALYTIC_CUSTOMER")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ----------------------------------------------------------------- segments row by row
@register("monetary_segment_rows", O.with_domain(*SEG, body=f"SELECT {ROW_KEYS}, monetary_segment, frequency_segment FROM seg"))
def monetary_segment_rows(spark, sf_dir):
    """Monetary and frequency bins of every customer and program."""
    return seg_rows(spark, sf_dir).select(*ROW_KEY_COLS, "monetary_segment", "frequency_segment")


# ----------------------------------------------------------------- co-located layout
def _facts(lay, read):
    """``read`` of the facts in buckets and of those apart."""
    return read(lay.trx) if lay.apart is None else read(lay.trx).unionByName(read(lay.apart))


@register("window_24m_months", O.with_domain(body=f"""
SELECT c.firm_id, cast(t.timed_id_transaction // 100 AS BIGINT) AS month, count(*) AS n_rows, sum(t.amount_after_discount) AS amount
FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
WHERE t.timed_id_transaction >= {P.profile_key} GROUP BY ALL"""), money=["amount"])
def window_24m_months(spark, sf_dir):
    """The 24-month window from facts in a folder per month: older folders are not read."""
    lay = staged_layout(spark, sf_dir)
    t = _facts(lay, lambda f: window(rfm_ops.valid_transactions(f), P.profile_key))
    return t.groupBy("firm_id", F.col("month").cast("long").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount_after_discount").alias("amount"))


def firm_windows(d):
    """A window of its own for each tenant: the months before the as-of time, six for each step of its id."""
    start = F.add_months(P.as_of_date_col, -6 * F.col("firm_id").cast("int"))
    return d.prog.select("firm_id").distinct().select(
        "firm_id", F.date_format(start, "yyyyMMdd").cast("int").alias("from_key"),
        F.date_format(P.as_of_date_col, "yyyyMMdd").cast("int").alias("to_key"))


@register("window_per_firm", O.with_domain(body=f"""
SELECT c.firm_id, count(*) AS n_rows, cast(min(t.timed_id_transaction) AS BIGINT) AS first_key, sum(t.amount_after_discount) AS amount
FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
WHERE t.timed_id_transaction <= cast(strftime(cast({O.ts(P.as_of)} AS DATE), '%Y%m%d') AS BIGINT)
  AND t.timed_id_transaction >= cast(strftime(cast({O.ts(P.as_of)} AS DATE)
        - to_months(cast(6 * c.firm_id AS INTEGER)), '%Y%m%d') AS BIGINT)
GROUP BY c.firm_id"""), money=["amount"])
def window_per_firm(spark, sf_dir):
    """Each tenant's own window: the scan is pruned at run time by the months of the tenants' windows."""
    lay = staged_layout(spark, sf_dir)
    t = _facts(lay, lambda f: window_by_firm(rfm_ops.valid_transactions(f), firm_windows(lay)))
    return t.groupBy("firm_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.min("timed_id_transaction").cast("long").alias("first_key"),
                                    F.sum("amount_after_discount").alias("amount"))


@register("rfm_colocated", O.with_domain(O.rfm_cte(), body="SELECT * FROM rfm"),
          money=RFM_MONEY, rnd={c: 4 for c in RATIO_COLS})
def rfm_colocated(spark, sf_dir):
    """RFM rows from bucketed facts and customers, without any exchange."""
    return colocated.rfm_aggregate(staged_layout(spark, sf_dir), P)


@register("all_data_colocated", O.with_domain(O.rfm_cte(), O.profile_cte(), O.all_data_cte(), body="SELECT * FROM all_data"),
          money=PROFILE_MONEY + RFM_MONEY, rnd={**{c: 6 for c in PROFILE_DOUBLES}, **{c: 4 for c in RATIO_COLS}})
def all_data_colocated(spark, sf_dir):
    """Profile and RFM rows joined bucket by bucket."""
    return colocated.all_data(staged_layout(spark, sf_dir), P)


FEATURES_SHOWN = ["avg_days_between_transactions", "median_basket_size", "basket_size_stddev", "distinct_transactions"]


@register("features_colocated", O.with_domain(*CH_TRAIN, body=f"""
SELECT firm_id, unique_customer_id, program_id, {', '.join(FEATURES_SHOWN)} FROM feats"""),
          rnd={c: CH_RND[c] for c in FEATURES_SHOWN if c in CH_RND})
def features_colocated(spark, sf_dir):
    """Gaps between purchases, medians and deviations from the buckets as they lie."""
    return colocated.transaction_features(staged_layout(spark, sf_dir), P).select(*CH_KEYS, *FEATURES_SHOWN)
