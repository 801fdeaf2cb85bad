"""Composite customer-level plans: segmentation prep -> segments -> ANALYTIC_CUSTOMER."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile as prof
from ..operators import reshape
from ..operators import rfm as rfm_ops
from ..operators import segments as seg
from ..functions.stats import money_ratio_2dp
from ..params import DEFAULT, RunParams
from ..sources.domain import Domain


def segmentation_input(d: Domain, params: RunParams = DEFAULT) -> DataFrame:
    """ANALYTIC_ALL_DATA from the domain tables."""
    return prof.all_data(rfm_ops.rfm_aggregate(d.trx, d.cust, d.prog, params),
                         prof.purchase_profile(d.trx, d.cust, d.best, d.prog, params))


def segmented_rows(d: Domain, params: RunParams = DEFAULT) -> DataFrame:
    """Per (customer, program) rows with every RFM and CLV segment column."""
    return seg.segment_customers(segmentation_input(d, params), params)


def p_code_values(rows: DataFrame) -> DataFrame:
    """Segment metrics formatted as the strings stored in the P-columns."""
    return rows.select(
        "firm_id", "unique_customer_id", "kart_tip_detay",
        F.date_format("ilk_odeme_dt", "yyyyMMdd").alias("ilk_odeme_tarih"),
        F.col("son_odeme_tarih").cast("string").alias("son_odeme_tarih"),
        F.col("recency").cast("string").alias("recency"),
        F.col("frequency").cast("string").alias("frequency"),
        F.col("monetary").cast("decimal(38,2)").cast("string").alias("monetary"),
        "recency_segment", "monetary_segment", "frequency_segment",
        "indirim_duyarli_segment", "indirim_beklentisi_segment",
        F.col("customer_lifespan").cast("string").alias("customer_lifespan"),
        money_ratio_2dp("musteri_toplam_ciro", "alisveris_adedi").cast("string").alias("avg_purchase_value"),
        F.col("clv").cast("long").cast("string").alias("clv"),
        "clv_segment",
    )


def audit_columns(df: DataFrame, params: RunParams = DEFAULT, model_id: int | None = None) -> DataFrame:
    """CREATED_BY / UPDATED_BY / CREATE_DATE / UPDATE_DATE (+ MODEL_ID) from the run parameters."""
    cols = {
        "created_by": F.lit(params.created_by),
        "updated_by": F.lit(params.created_by),
        "create_date": params.audit_ts_col,
        "update_date": params.audit_ts_col,
    }
    if model_id is not None:
        cols["model_id"] = F.lit(model_id).cast("long")
    return df.withColumns(cols)


LABEL_CODES = ["P6", "P7", "P8", "P9", "P10", "P15"]


def analytic_customer(rows: DataFrame, params: RunParams = DEFAULT, language: str = "en") -> DataFrame:
    """ANALYTIC_CUSTOMER (segment part): one row per customer, P-codes as strings.

    Multi-program customers keep the first non-NULL value per code ordered by
    program name (deterministic form of ``pivot_table(aggfunc='first')``).
    ``language="tr"`` writes the Turkish display labels for the segment codes
    (the firm KPIs read the canonical English codes)."""
    wide = reshape.to_p_codes(p_code_values(rows), ["firm_id", "unique_customer_id"],
                              reshape.SEGMENT_P_CODES, order="kart_tip_detay")
    if language == "tr":
        wide = wide.withColumns({c: seg.localize(c) for c in LABEL_CODES})
    elif language != "en":
        raise ValueError(f"unsupported language {language!r}")
    return audit_columns(wide, params)


def churn_p_codes(scored: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """ANALYTIC_CUSTOMER churn part: P13, P16-P26 as strings, one row per customer
    (first non-NULL value per code by program id)."""
    vals = scored.select(
        "firm_id", "unique_customer_id", F.col("program_id").alias("_order"),
        *[F.col(c).cast("string").alias(c) for c in (
            "avg_days_between_transactions", "days_since_last_transaction", "customer_lifetime",
            "distinct_transactions", "avg_spent", "max_spent", "total_used_point", "churn_prob")],
        F.col("is_churn_label").alias("is_churn"), "churn_class",
        F.col("program_id").cast("string").alias("program_id"),
        F.col("model_id").cast("string").alias("model_id"))
    wide = reshape.to_p_codes(vals, ["firm_id", "unique_customer_id"], reshape.CHURN_P_CODES, order="_order")
    return audit_columns(wide, params)


def merge_customer_parts(segments: DataFrame, churn: DataFrame) -> DataFrame:
    """One ANALYTIC_CUSTOMER row per customer: segment codes and churn codes side by side
    (full outer join on the customer instead of appending second rows)."""
    keys = ["firm_id", "unique_customer_id"]
    audit = ["created_by", "updated_by", "create_date", "update_date"]
    s = segments.drop(*audit)
    c = churn.drop(*audit)
    j = s.join(c, keys, "full")
    codes = sorted([x for x in j.columns if x not in keys], key=lambda x: int(x[1:]))
    return j.select(*keys, *codes)
