"""Firm-level KPIs and the generated narrative (ANALYTIC_FIRM_BASED), all firms at once.

Input is ANALYTIC_CUSTOMER (one row per customer, P-codes as strings). The
KPI query is two aggregates - all customers and last-12-month customers -
joined on ``firm_id`` (left join, so a firm without recent customers keeps
NULL KPIs). Medians are exact and distributed (no firm in one task).
The narrative is a string expression per firm row: no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import pct_half_up
from ..functions.text import month_name_tr, thousands, tr_suffix
from ..params import DEFAULT, RunParams, ts_lit
from . import segments as S
from ..session import cut_lineage
from .selection import percentiles

MEDIAN_CODES = {"median_recency": "P3", "median_frequency": "P4", "median_monetary_value": "P5",
                "median_customer_lifespan_value": "P11", "median_avg_purchase_value": "P12",
                "median_clv_value": "P14"}


def _num(code: str) -> Column:
    return F.col(code).try_cast("double")


def firm_totals(ac: DataFrame) -> DataFrame:
    """All-time half of the firm KPIs: first purchase year/month, customer counts by CLV segment."""
    first = F.to_date(F.min("P1"), "yyyyMMdd")
    g = ac.groupBy("firm_id").agg(
        F.year(first).alias("earliest_trn_year"),
        F.month(first).alias("earliest_trn_month"),
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("P15") == S.CLV_VIP).alias("total_vip_customer_count"),
        F.count_if(F.col("P15") == S.CLV_LOYAL).alias("total_loyal_customer_count"),
        F.count_if(F.col("P15") == S.CLV_ONE_TIME).alias("total_one_time_customer_count"),
        F.count_if(F.col("P15") == S.CLV_RISK).alias("_total_at_risk"),
    )
    return g.withColumns({
        "total_vip_customer_pct": pct_half_up("total_vip_customer_count", "total_customers"),
        "total_loyal_customer_pct": pct_half_up("total_loyal_customer_count", "total_customers"),
        "total_one_time_customer_pct": pct_half_up("total_one_time_customer_count", "total_customers"),
    })


LAST_YEAR_COUNTS = {
    "new_customer": ("P6", S.RECENCY_NEW),
    "active_customer": ("P6", S.RECENCY_ACTIVE),
    "one_time_customer": ("P15", S.CLV_ONE_TIME),
    "vip_customer": ("P15", S.CLV_VIP),
    "loyal_customer": ("P15", S.CLV_LOYAL),
    "potential_growth_customer": ("P15", S.CLV_GROWTH),
    "at_risk_customer": ("P6", S.RECENCY_AT_RISK),
    "churn_risk_customer": ("P15", S.CLV_RISK),
}


def last_year_customers(ac: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    cutoff = ts_lit(params.months_back(12))
    return ac.where(F.to_date("P2", "yyyyMMdd").cast("timestamp_ntz") >= cutoff)


def firm_last_year(ac: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Counts and percentages over customers whose last purchase is in the last 12 months."""
    ly = last_year_customers(ac, params)
    g = ly.groupBy("firm_id").agg(
        F.count(F.lit(1)).alias("customer_count"),
        *[F.count_if(F.col(code) == label).alias(f"{name}_count")
          for name, (code, label) in LAST_YEAR_COUNTS.items()])
    return g.withColumns({f"{name}_pct": pct_half_up(f"{name}_count", "customer_count")
                          for name in LAST_YEAR_COUNTS})


def firm_medians(ac: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Exact medians of six numeric P-codes over last-year customers, per firm, as
    decimal(38,3) (the P-values carry at most 2 decimals, so the median is exact at 3)."""
    ly = last_year_customers(ac, params)
    long = ly.select("firm_id", *[_num(c).alias(n) for n, c in MEDIAN_CODES.items()]) \
        .unpivot("firm_id", list(MEDIAN_CODES), "metric", "value")
    med = percentiles(long, ["firm_id", "metric"], "value", {"median": 0.5})
    return med.groupBy("firm_id").agg(*[
        F.max(F.when(F.col("metric") == n, F.round("median", 3).cast("decimal(38,3)"))).alias(n)
        for n in MEDIAN_CODES])


def _pct2(n, d) -> Column:
    return pct_half_up(n, d, 2)


def firm_kpis(ac: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """The firm KPI row: totals left-joined with last-year counts and medians, plus
    conversion, retention, new-customer contribution, lost and projected revenue."""
    ac = cut_lineage(ac)  # read by three aggregates
    tot = firm_totals(ac)
    ly = firm_last_year(ac, params).join(firm_medians(ac, params), "firm_id", "left")
    j = tot.join(ly, "firm_id", "left")
    aov = F.col("median_avg_purchase_value")
    return j.withColumns({
        "last_year_customer_count": F.col("customer_count"),
        "total_churn_risk_customer_count": F.col("churn_risk_customer_count"),
        "total_churned_customer_count": F.col("_total_at_risk") - F.col("churn_risk_customer_count"),
        "one_time_to_active_conversion_rate": _pct2(F.col("active_customer_count") - F.col("one_time_customer_count"),
                                                    F.col("active_customer_count")),
        "retention_ratio": _pct2(F.col("active_customer_count"), F.col("customer_count")),
        "new_customer_contribution_pct": _pct2(F.col("new_customer_count"), F.col("active_customer_count")),
        "lost_revenue_from_churn_risk": F.round(F.col("churn_risk_customer_count").cast("decimal(20,0)") * aov, 2),
        "projected_revenue_from_active_customers": F.round(
            F.col("active_customer_count").cast("decimal(20,0)") * aov, 2),
    }).drop("_total_at_risk", "customer_count")


def _pd_round(x: Column, d: int) -> Column:
    return F.bround(x.cast("double"), d)


def derive_kpis(k: DataFrame) -> DataFrame:
    """Post-derivations of the narrative step: churn-risk share of last-year customers,
    actual churn rate, integer rounding of money medians and revenues (half-even)."""
    return k.withColumns({
        "churned_customer_count": F.col("total_churned_customer_count"),
        "total_churn_risk_customer_pct": _pd_round(
            F.try_divide(F.col("total_churn_risk_customer_count"), F.col("last_year_customer_count")) * F.lit(100), 1),
        "actual_churn_rate": _pd_round(
            F.try_divide(F.col("total_churned_customer_count"), F.col("total_customers")) * F.lit(100), 1),
        "median_monetary_value_int": _pd_round(F.col("median_monetary_value"), 0).cast("long"),
        "median_avg_purchase_value_int": _pd_round(F.col("median_avg_purchase_value"), 0).cast("long"),
        "lost_revenue_int": _pd_round(F.col("lost_revenue_from_churn_risk"), 0).cast("long"),
        "projected_revenue_int": _pd_round(F.col("projected_revenue_from_active_customers"), 0).cast("long"),
        "new_customer_contribution_pct_1": _pd_round(F.col("new_customer_contribution_pct"), 1),
        "retention_ratio_1": _pd_round(F.col("retention_ratio"), 1),
    })


def insight_rules(d: DataFrame) -> DataFrame:
    """Which recommendation branch fires, per firm (NULL comparisons take the else branch)."""
    ret = F.col("retention_ratio_1")
    return d.withColumns({
        "rule_retention": F.when(ret > 80, "strong").when(ret < 50, "weak").otherwise("none"),
        "rule_vip": F.when(F.col("vip_customer_pct") < 10, "low").otherwise("high"),
        "rule_conversion": F.when(F.col("one_time_to_active_conversion_rate") > 50, "high").otherwise("low"),
        "rule_growth": F.when(F.col("potential_growth_customer_pct") > F.col("total_churn_risk_customer_pct"),
                              "growth").otherwise("risk"),
    })


def num_text(x, decimals: int = 2) -> Column:
    """Number printed with up to ``decimals`` decimals, trailing zeros and '.' trimmed."""
    v = F.col(x) if isinstance(x, str) else x
    s = F.regexp_replace(F.format_number(v.cast("double"), decimals), ",", "")
    s = F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1")
    return F.regexp_replace(s, r"\.$", "")


def pct_with_suffix(x) -> Column:
    t = num_text(x, 2)
    return F.concat(F.lit("%"), t, tr_suffix(t))


# --- fixed values: narrative template (Turkish), sentence by sentence ---
T_INTRO = ("Veritabanında yer alan {firm} verilerine göre, {year} yılının {month} ayından itibaren {total} müşteri "
           "{firm} markasından alışveriş yaptı. "
           "Son 12 aylık döneme bakıldığında ise toplamda {ly} müşterinin alışveriş yapmış ve bu müşterilerin "
           "{active_pct} son üç aylık dönemde aktif olarak alışveriş yapmaya devam etmiştir. "
           "RFM ve CLV analizleri sonucunda aktif müşterilerden beklenen bir yıllık toplam potansiyel gelir "
           "{projected} TL olarak tahminlenmiştir. "
           "Aktif müşterilerin yaklaşık {retention_pct} son 12 aylık müşteri tabanından gelmektedir.")
T_RET_STRONG = ("Bu oran, müşteri sadakat stratejilerinizin oldukça güçlü olduğunu göstermektedir. "
                "Sadık müşterilerinizle ilişkilerinizi geliştirmek için özel kampanyalar düzenleyebilirsiniz.\n\n")
T_RET_WEAK = ("Bu oran, müşteri sadakat stratejilerinizin güçlendirilmesi gerektiğine işaret ediyor. "
              "Müşteri bağlılığını artırmak için düzenli iletişim ve ödül programları önerilebilir.\n\n")
T_RFM = ("Müşteri davranışlarını analiz etmek için kullanılan RFM (Recency-Frequency-Monetary) modelinin "
         "sonuçlarına göre, bir müşterinin ortalama son alışveriş süresi {recency} gün, ortalama alışveriş sıklığı "
         "{frequency} ve işlem başına ortalama harcama tutarı {monetary} TL olarak ölçüldü. ")
T_SEGMENTS = ("CLV ve RFM modellerinin sonuçları göz önüne alınarak {firm} markasının müşteri portföyü 6 farklı "
              "segmente ayrıldı:\n\n"
              "**VIP Müşteriler**: İşlem başına harcama tutarları veya yaşam boyu değerleri (CLV) en üst %20'lik "
              "dilimde olan müşterilerdir. "
              "Son bir yılda alışveriş yapmış müşterilerin {vip_pct} VIP segmentindedir. ")
T_VIP_LOW = ("VIP müşteri oranı düşük görünüyor. Bu segmenti genişletmek için özel fırsatlar ve kampanyalar "
             "oluşturulabilir.\n\n")
T_VIP_HIGH = "VIP müşteri oranı oldukça yüksek ve bu grup markaya en büyük gelir katkısını sağlıyor.\n\n"
T_LOYAL = ("**Sadık Müşteriler**: Düzenli alışveriş yapan ve alışveriş sıklığı üst %30’luk dilimde yer alan "
           "müşterilerden oluşuyor. "
           "Toplam müşterilerinizin {loyal_pct} sadık müşteri segmentinde yer alıyor.\n\n")
T_ONE_TIME = ("**Tek Seferlik Müşteriler**: {firm} markasından bir kez alışveriş yapmış müşterilerdir. "
              "Son bir yılda alışveriş yapan müşterilerin {one_time_pct} ikinci kez alışveriş yapmamıştır. ")
T_CONV_HIGH = ("Tek seferlik müşterilerinizin düzenli müşterilere dönüşme oranı %{conversion} ile oldukça yüksek. "
               "Tek seferlik müşteriler, iyi bir dönüşüm oranı ile sadakat segmentine taşınabilir."
               "Bu trendi sürdürmek için yeni müşterilere kişiselleştirilmiş kampanyalar düzenleyebilirsiniz.\n\n")
T_CONV_LOW = ("Tek seferlik müşterilerin düzenli müşterilere dönüşme oranı %{conversion} seviyesindedir. "
              "Tek seferlik müşteriler, iyi bir dönüşüm oranı ile sadakat segmentine taşınabilir."
              "Daha fazla dönüşüm için hoş geldiniz indirimleri ve müşteri ödül programları "
              "düzenleyebilirsiniz.\n\n")
T_CHURN_RISK = ("**Kayıp Riski Taşıyan Müşteriler**: Son dönemlerde alışveriş yapmamış ve harcama düzeyleri düşük "
                "olan müşterilerden oluşuyor. "
                "Son 12 ayda alışveriş yapan müşterilerinizin {churn_risk_pct} bu segmentte yer alıyor. "
                "Kayıp riski taşıyan müşterilere odaklanarak tahmini {lost} TL'lik gelir kaybının önüne "
                "geçebilirsiniz.\n\n")
T_CHURNED = ("**Kayıp Müşteriler**: Son 12 aydan uzun süredir alışveriş yapmamış müşterilerden oluşuyor. "
             "Toplam {churned} müşteri (%{churned_pct}) bu segmentte yer alıyor. "
             "Kayıp müşterilerin geri kazanımı için özel iletişim stratejileri geliştirebilirsiniz.\n\n")
T_GROWTH = ("**Potansiyel Büyüme Müşterileri**: Harcamalarını artırma potansiyeline sahip müşterilerden oluşur. "
            "Son 12 ayda alışveriş yapmış müşterilerinizin {growth_pct} bu segmentte yer alıyor. ")
T_GROWTH_UP = ("Potansiyel büyüme müşterilerinin oranı kayıp riski taşıyan müşterilerden daha yüksek. Bu da {firm} "
               "için büyüme fırsatları sunuyor. "
               "Bu müşterilere yönelik hedefli kampanyalar ile bu segmentten elde edilen geliri arttırabilirsiniz.")
T_GROWTH_DOWN = ("Potansiyel büyüme müşterilerinin oranı kayıp riski taşıyan müşterilere kıyasla düşüktür. "
                 "Kayıp riski taşıyan müşterileri bu segmente taşımak için özel teklifler sunabilirsiniz.")
T_SEGMENT_SENTENCE = ("{segment} segmentinde toplam {count} müşteri bulunmakta olup, ortalama harcama tutarı "
                      "{monetary} TL ve alışveriş sıklığı {frequency} olarak belirlenmiştir.")
# --- end of fixed values ---


def fill(template: str, **cols: Column) -> Column:
    """Template with ``{name}`` slots -> ``concat`` of literal pieces and columns (NULL -> 'nan')."""
    import re

    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(cols[m.group(1)].cast("string"), F.lit("nan")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def insight_text(d: DataFrame, firm_name: str = "firm_name") -> DataFrame:
    """SMART_INSIGHT: the portfolio narrative per firm (input: ``insight_rules`` output + firm name)."""
    firm = F.col(firm_name)
    intro = fill(T_INTRO, firm=firm, year=F.col("earliest_trn_year"),
                 month=month_name_tr(F.col("earliest_trn_month")), total=thousands(F.col("total_customers")),
                 ly=thousands(F.col("last_year_customer_count")),
                 active_pct=pct_with_suffix("active_customer_pct"),
                 projected=thousands(F.col("projected_revenue_int")),
                 retention_pct=pct_with_suffix("retention_ratio_1"))
    ret = (F.when(F.col("rule_retention") == "strong", F.lit(T_RET_STRONG))
           .when(F.col("rule_retention") == "weak", F.lit(T_RET_WEAK)).otherwise(F.lit("")))
    rfm = fill(T_RFM, recency=num_text("median_recency"), frequency=num_text("median_frequency"),
               monetary=thousands(F.col("median_monetary_value_int")))
    segs = fill(T_SEGMENTS, firm=firm, vip_pct=pct_with_suffix("vip_customer_pct"))
    vip = F.when(F.col("rule_vip") == "low", F.lit(T_VIP_LOW)).otherwise(F.lit(T_VIP_HIGH))
    loyal = fill(T_LOYAL, loyal_pct=pct_with_suffix("loyal_customer_pct"))
    one = fill(T_ONE_TIME, firm=firm, one_time_pct=pct_with_suffix("one_time_customer_pct"))
    conv_t = num_text("one_time_to_active_conversion_rate")
    conv = F.when(F.col("rule_conversion") == "high", fill(T_CONV_HIGH, conversion=conv_t)) \
        .otherwise(fill(T_CONV_LOW, conversion=conv_t))
    risk = fill(T_CHURN_RISK, churn_risk_pct=pct_with_suffix("total_churn_risk_customer_pct"),
                lost=thousands(F.col("lost_revenue_int")))
    churned = fill(T_CHURNED, churned=thousands(F.col("churned_customer_count")),
                   churned_pct=num_text("actual_churn_rate"))
    growth = fill(T_GROWTH, growth_pct=pct_with_suffix("potential_growth_customer_pct"))
    g2 = F.when(F.col("rule_growth") == "growth", fill(T_GROWTH_UP, firm=firm)).otherwise(F.lit(T_GROWTH_DOWN))
    text = F.concat(intro, ret, rfm, segs, vip, loyal, one, conv, risk, churned, growth, g2)
    return d.withColumn("smart_insight", text)


def firm_insight(ac: DataFrame, firms: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """KPIs -> derivations -> rules -> narrative, one row per firm."""
    k = insight_rules(derive_kpis(firm_kpis(ac, params)))
    names = firms.select(F.col("id").cast("long").alias("firm_id"), "firm_name")
    return insight_text(k.join(names, "firm_id", "left"))


def segment_text(ac: DataFrame) -> DataFrame:
    """One sentence per CLV segment (count, average spend, average frequency), joined by a
    blank, per firm. Averages are exact (integer arithmetic on sums), rounded half-up."""
    g = ac.groupBy("firm_id", F.col("P15").alias("segment_name")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum(F.col("P5").cast("decimal(38,2)")).alias("_mon"),
        F.sum(F.col("P4").cast("long")).alias("_frq"))
    n = F.col("customer_count")
    mon_int = (F.signum(F.col("_mon")) * F.floor((F.abs(F.col("_mon")) * 2 + n) / (n * 2))).cast("long")
    frq100 = F.floor((F.col("_frq") * 200 + n) / (n * 2)).cast("long")
    frq_txt = F.format_string("%d.%02d", (frq100 / 100).cast("long"), frq100 % 100)
    sent = fill(T_SEGMENT_SENTENCE, segment=F.col("segment_name"), count=thousands(n),
                monetary=F.concat(thousands(mon_int), F.lit(".0")), frequency=frq_txt)
    s = g.select("firm_id", "segment_name", sent.alias("sentence"))
    return s.groupBy("firm_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_name", "sentence"))),
                                 lambda x: x["sentence"]), " ").alias("segment_insight"))


# --- fixed values: firm metric dictionary (DEFINITION_NAME -> DEFINITION_NO) ---
FIRM_P_CODES = {
    "TOTAL_CUSTOMERS": "P1", "TOTAL_VIP_CUSTOMER_COUNT": "P2", "TOTAL_VIP_CUSTOMER_PCT": "P3",
    "TOTAL_LOYAL_CUSTOMER_COUNT": "P4", "TOTAL_LOYAL_CUSTOMER_PCT": "P5", "TOTAL_ONE_TIME_CUSTOMER_COUNT": "P6",
    "TOTAL_ONE_TIME_CUSTOMER_PCT": "P7", "LAST_YEAR_CUSTOMER_COUNT": "P8", "ACTIVE_CUSTOMER_COUNT": "P9",
    "ACTIVE_CUSTOMER_PCT": "P10", "NEW_CUSTOMER_COUNT": "P11", "NEW_CUSTOMER_PCT": "P12",
    "CHURN_RISK_CUSTOMER_COUNT": "P13", "CHURN_RISK_CUSTOMER_PCT": "P14", "RETENTION_RATIO": "P15",
    "ONE_TIME_TO_ACTIVE_CONVERSION_RATE": "P16", "SMART_INSIGHT": "P17",
}
# --- end of fixed values ---


def definitions(spark) -> DataFrame:
    """DEF_FIRM_METRICS as a DataFrame."""
    return spark.createDataFrame(list(FIRM_P_CODES.items()), "definition_name string, definition_no string")


def firm_based(ac: DataFrame, firms: DataFrame, defs: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """ANALYTIC_FIRM_BASED: the firm row with the narrative, post-derived values in place,
    renamed to P-codes by the definition table, values as strings, audit columns."""
    from .reshape import rename_by_table

    k = firm_insight(ac, firms, params).withColumns({
        "retention_ratio": F.col("retention_ratio_1"),
        "new_customer_contribution_pct": F.col("new_customer_contribution_pct_1"),
        "median_monetary_value": F.col("median_monetary_value_int"),
        "median_avg_purchase_value": F.col("median_avg_purchase_value_int"),
        "lost_revenue_from_churn_risk": F.col("lost_revenue_int"),
        "projected_revenue_from_active_customers": F.col("projected_revenue_int"),
    })
    out = rename_by_table(k, defs, ["firm_id"])
    return out.withColumns({
        "created_by": F.lit(params.created_by), "updated_by": F.lit(params.created_by),
        "create_date": params.audit_ts_col, "update_date": params.audit_ts_col})
