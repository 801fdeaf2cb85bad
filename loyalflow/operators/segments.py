"""RFM and CLV segmentation (ANALYTIC_CUSTOMER segment part), all tenants in one job.

Per-firm statistics (min/max, sqrt mean/std, medians, CLV quantiles) are
computed once as small per-firm tables - a partial/final aggregate and one
distributed exact-percentile job over a long (firm, metric, value) frame -
then joined back on ``firm_id`` (broadcast behind a row-count check). No
un-partitioned window is used, so no firm is ever pulled into one task.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date_key
from ..functions.stats import equal_width_bin
from ..params import DEFAULT, RunParams, ts_lit
from ..session import cut_lineage
from .joins import broadcast_checked
from .ranking import row_positions
from .selection import percentiles

# --- fixed values: segment labels (canonical codes used by the firm KPIs) ---
RECENCY_PASSIVE = "Passive Customer"
RECENCY_ACTIVE = "Active Customer"
RECENCY_AT_RISK = "Active - at risk"
RECENCY_NEW = "New Customer"
MONETARY_LABELS = ["low", "modest", "middle", "high", "very high"]
FREQUENCY_SINGLE = "single purchase"
FREQUENCY_LABELS = ["rare", "medium", "frequent"]
DISCOUNT_SENSITIVE, DISCOUNT_INSENSITIVE = "discount sensitive", "discount insensitive"
EXPECTATION_HIGH, EXPECTATION_STANDARD = "high expectation", "standard expectation"
CLV_ONE_TIME = "One-time Buyer"
CLV_VIP = "VIP Customer"
CLV_LOYAL = "Loyal Customer"
CLV_GROWTH = "Potential Growth Customer"
CLV_RISK = "at Risk"
# Turkish display names of the same labels.
TURKISH_LABELS = {
    RECENCY_PASSIVE: "pasif müşteri", RECENCY_ACTIVE: "aktif müşteri", RECENCY_AT_RISK: "aktif - riskli",
    RECENCY_NEW: "markayla yeni temas eden",
    "low": "düşük", "modest": "mütevazi", "middle": "orta halli", "high": "yüksek", "very high": "çok yüksek",
    FREQUENCY_SINGLE: "tek alışveriş", "rare": "seyrek", "medium": "orta", "frequent": "sık",
    DISCOUNT_SENSITIVE: "indirime_duyarli", DISCOUNT_INSENSITIVE: "indirime_duyarsiz",
    EXPECTATION_HIGH: "yüksek seviyede", EXPECTATION_STANDARD: "standart seviyede",
    CLV_ONE_TIME: "Tek Seferlik Müşteri", CLV_VIP: "VIP Müşteri", CLV_LOYAL: "Sadık Müşteri",
    CLV_GROWTH: "Potansiyel Büyüme Müşterisi", CLV_RISK: "Riskli Müşteri",
}
# --- end of fixed values ---

# Upper bound on tenants whose statistics may be broadcast.
FIRM_ROWS = 100_000


def localize(col, mapping: dict = TURKISH_LABELS):
    """Display-language label for a canonical label column."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.element_at(m, c), c)


def _label(idx_col, labels):
    arr = F.array(*[F.lit(x) for x in labels])
    return F.element_at(arr, idx_col)


def _sqrt_or_null(c):
    return F.when(c >= 0, F.sqrt(c))


def with_dates(all_data: DataFrame) -> DataFrame:
    """Parse the two ``yyyyMMdd`` keys; rows with an unparseable key are dropped."""
    return (all_data
            .withColumn("son_alv_dt", parse_date_key("son_alv_tarih"))
            .withColumn("ilk_odeme_dt", parse_date_key("ilk_odeme_tarih"))
            .dropna(subset=["son_alv_dt", "ilk_odeme_dt"]))


def recency_segment(params: RunParams = DEFAULT):
    """Later rules win: new (first purchase recent) > at risk > active > passive."""
    last = F.col("son_alv_dt").cast("timestamp_ntz")
    first = F.col("ilk_odeme_dt").cast("timestamp_ntz")
    active = ts_lit(params.as_of - timedelta(days=params.active_days))
    risk = ts_lit(params.as_of - timedelta(days=params.risk_days))
    new = ts_lit(params.as_of - timedelta(days=params.new_days))
    return (F.when(first >= new, RECENCY_NEW)
            .when((last >= risk) & (last < active), RECENCY_AT_RISK)
            .when(last >= active, RECENCY_ACTIVE)
            .otherwise(RECENCY_PASSIVE))


QUANTILE_METRICS = {
    "ind": "ind_alv_orani", "ort": "ort_indirim_orani",
    "clv": "clv", "aov": "avg_purchase_value", "freq": "avg_purchase_frequency_rate", "life": "customer_lifespan",
}
CLV_METRICS = {k: QUANTILE_METRICS[k] for k in ("clv", "aov", "freq", "life")}


def firm_quantiles(d: DataFrame) -> DataFrame:
    """Every per-firm quantile the segments need (discount medians; q30/q50/q80 of CLV,
    order value, frequency, lifespan) from ONE distributed exact-percentile pass over a
    long (firm, metric, value) frame."""
    v = clv_values(d)
    long = v.select("firm_id", *[F.col(c).cast("double").alias(k) for k, c in QUANTILE_METRICS.items()]) \
        .unpivot("firm_id", list(QUANTILE_METRICS), "metric", "value")
    q = percentiles(long, ["firm_id", "metric"], "value", {"q30": 0.3, "q50": 0.5, "q80": 0.8})
    return q.groupBy("firm_id").agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}")
                                      for m in QUANTILE_METRICS for c in ("q30", "q50", "q80")])


def firm_stats(d: DataFrame, quantiles: DataFrame | None = None) -> DataFrame:
    """Per-firm min/max/sqrt statistics plus the per-firm quantiles."""
    mon = F.col("monetary").cast("double")
    frq = F.col("frequency").cast("double")
    multi = F.col("frequency") > 1
    basic = d.groupBy("firm_id").agg(
        F.min(mon).alias("mon_min"), F.max(mon).alias("mon_max"),
        F.min(frq).alias("frq_min"), F.max(frq).alias("frq_max"),
        F.min(F.when(multi, frq)).alias("frq2_min"), F.max(F.when(multi, frq)).alias("frq2_max"),
        F.avg(_sqrt_or_null(mon)).alias("mon_sqrt_mean"), F.stddev_samp(_sqrt_or_null(mon)).alias("mon_sqrt_std"),
        F.avg(_sqrt_or_null(frq)).alias("frq_sqrt_mean"), F.stddev_samp(_sqrt_or_null(frq)).alias("frq_sqrt_std"),
    )
    q = quantiles if quantiles is not None else firm_quantiles(d)
    return basic.join(q, "firm_id", "left").withColumnsRenamed(
        {"ind_q50": "ind_alv_orani_median", "ort_q50": "ort_indirim_orani_median"})


def _apply_rfm(x: DataFrame, params: RunParams) -> DataFrame:
    """RFM segment columns on rows already joined with their firm's statistics."""
    mon = F.col("monetary").cast("double")
    frq = F.col("frequency").cast("double")

    def cap(sq, mean, std):
        thr = F.col(mean) + F.lit(3.0) * F.col(std)
        return F.when(sq > thr, thr).otherwise(sq)

    def scaled(v, lo, hi):
        rng = F.col(hi) - F.col(lo)
        return F.when(rng == 0, F.lit(0.0)).otherwise(F.try_divide(v - F.col(lo), rng))

    mon_bin = equal_width_bin(mon, F.col("mon_min"), F.col("mon_max"), 5)
    frq_bin = equal_width_bin(frq, F.col("frq2_min"), F.col("frq2_max"), 3)
    return x.withColumns({
        "recency_segment": recency_segment(params),
        "monetary_sqrt": cap(_sqrt_or_null(mon), "mon_sqrt_mean", "mon_sqrt_std"),
        "frequency_sqrt": cap(_sqrt_or_null(frq), "frq_sqrt_mean", "frq_sqrt_std"),
        "monetary_scaled": scaled(mon, "mon_min", "mon_max"),
        "frequency_scaled": scaled(frq, "frq_min", "frq_max"),
        "monetary_segment": _label(mon_bin, MONETARY_LABELS),
        "frequency_segment": F.when(F.col("frequency") == 1, F.lit(FREQUENCY_SINGLE))
        .when(F.col("frequency") > 1, _label(frq_bin, FREQUENCY_LABELS)),
        "indirim_duyarli_segment": F.when(F.col("ind_alv_orani") > F.col("ind_alv_orani_median"),
                                          DISCOUNT_SENSITIVE).otherwise(DISCOUNT_INSENSITIVE),
        "indirim_beklentisi_segment": F.when(F.col("ort_indirim_orani") > F.col("ort_indirim_orani_median"),
                                             EXPECTATION_HIGH).otherwise(EXPECTATION_STANDARD),
    })


def _with_stats(all_data: DataFrame):
    """Materialize the per-(customer, program) input once (reliable checkpoint in the shared
    folder: the statistics and the rows both read it) and join the per-firm statistics.
    The statistics (one row per firm) are made first and broadcast behind a size check,
    so that the rows are not shuffled onto one key per firm."""
    d = cut_lineage(with_dates(all_data))
    stats = cut_lineage(firm_stats(d))
    return d.join(broadcast_checked(stats, FIRM_ROWS), "firm_id"), [c for c in stats.columns if c != "firm_id"]


def rfm_segments(all_data: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Recency / monetary / frequency / discount segments per (customer, program) row."""
    x, stat_cols = _with_stats(all_data)
    return _apply_rfm(x, params).drop(*stat_cols)


def clv_values(d: DataFrame) -> DataFrame:
    """Lifespan (days, at least 1), average order value, frequency and CLV (half-even)."""
    life = F.greatest(F.datediff("son_alv_dt", "ilk_odeme_dt"), F.lit(1))
    aov = F.try_divide(F.col("musteri_toplam_ciro").cast("double"), F.col("alisveris_adedi").cast("double"))
    freq = F.col("alisveris_adedi").cast("double")
    d = d.withColumns({"customer_lifespan": life, "avg_purchase_value": aov,
                       "avg_purchase_frequency_rate": freq})
    clv = F.bround(F.col("avg_purchase_value") * F.col("avg_purchase_frequency_rate")
                   * (F.col("customer_lifespan").cast("double") / F.lit(365.0)), 0)
    return d.withColumn("clv", clv)


def clv_thresholds(d: DataFrame) -> DataFrame:
    """q30/q50/q80 of CLV, order value, frequency and lifespan per firm (exact, distributed)."""
    long = d.select("firm_id", *[F.col(c).cast("double").alias(k) for k, c in CLV_METRICS.items()]) \
        .unpivot("firm_id", list(CLV_METRICS), "metric", "value")
    q = percentiles(long, ["firm_id", "metric"], "value", {"q30": 0.3, "q50": 0.5, "q80": 0.8})
    return q.groupBy("firm_id").agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}")
                                      for m in CLV_METRICS for c in ("q30", "q50", "q80")])


def clv_rule():
    clv, aov = F.col("clv"), F.col("avg_purchase_value")
    freq, life = F.col("avg_purchase_frequency_rate"), F.col("customer_lifespan")
    return (F.when(freq == 1, CLV_ONE_TIME)
            .when((clv > F.col("clv_q80")) & (aov > F.col("aov_q80")), CLV_VIP)
            .when((clv > F.col("clv_q50")) & (freq > F.col("freq_q50")), CLV_LOYAL)
            .when((clv >= F.col("clv_q50")) & (life >= F.col("life_q50")), CLV_GROWTH)
            .otherwise(CLV_RISK))


def clv_segments(d: DataFrame) -> DataFrame:
    """Decision list: one-timer, VIP, loyal, potential growth, else at risk."""
    d = clv_values(d)
    th = cut_lineage(clv_thresholds(d))
    return d.join(broadcast_checked(th, FIRM_ROWS), "firm_id").withColumn("clv_segment", clv_rule()).drop(
        *[c for c in th.columns if c != "firm_id"])


def segment_customers(all_data: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """RFM then CLV segments on ANALYTIC_ALL_DATA rows; all per-firm statistics come from
    one aggregate and one percentile pass over the materialized input."""
    x, stat_cols = _with_stats(all_data)
    rows = clv_values(_apply_rfm(x, params)).withColumn("clv_segment", clv_rule())
    return rows.drop(*stat_cols)


def ntile_from_rank(rank, n, k: int):
    """``NTILE(k)`` bucket from a 0-based rank and group size (first buckets take the remainder)."""
    q = F.floor(n / F.lit(k)).cast("long")
    rem = n - q * F.lit(k)
    big = rem * (q + 1)
    return F.when(rank < big, F.floor(rank / (q + 1)) + 1).otherwise(
        rem + F.floor(F.try_divide(rank - big, q)) + 1).cast("int")


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """1-5 recency/frequency/monetary scores per firm and the "RFM" score string.

    Ranks of all three measures come from one pass of the distributed position operator over
    (firm, measure, value) rows; no per-firm window."""
    keys = ["firm_id", "unique_customer_id", "kart_tip_detay"]
    measures = {"r": -F.col("recency").cast("double"), "f": F.col("frequency").cast("double"), "m": F.col("monetary").cast("double")}
    long = rfm.select(*keys, F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("value"))
                                                 for k, v in measures.items()])).alias("_m")).select(*keys, "_m.*")
    ranked = row_positions(long, ["firm_id", "measure"], ["value", "unique_customer_id", "kart_tip_detay"])
    score = ntile_from_rank(F.col("_rank"), F.col("_n"), 5)
    wide = ranked.groupBy(*keys).agg(*[F.max(F.when(F.col("measure") == k, score)).alias(f"{k}_score") for k in measures])
    return wide.withColumn("rfm_score", F.concat(*[F.col(f"{k}_score").cast("string") for k in measures]))
