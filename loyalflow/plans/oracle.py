"""DuckDB SQL for the correctness gate.

Each entry is the ANSI-SQL twin of a Spark query in ``plans.catalog``. The
driver registers only the raw tables, so the domain mapping is inlined as
CTEs. Every output column is aliased and cast to the Spark type.
"""

from __future__ import annotations

from ..params import DEFAULT, RunParams

P = DEFAULT

DOMAIN_CTES = """
prog AS (
  SELECT f.firm_id, cast(r_regionkey AS INTEGER) AS program_id, r_name AS program_name
  FROM region, (SELECT cast(unnest([1, 2, 3]) AS BIGINT) AS firm_id) f
),
cust AS (
  SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS unique_customer_id,
    cast((c_custkey - c_custkey % 2) / 2 AS BIGINT) % 3 + 1 AS firm_id,
    cast(n_regionkey AS INTEGER) AS program_id,
    CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END AS is_deleted
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
trx AS (
  SELECT cast((customer_id - customer_id % 2) / 2 AS BIGINT) % 3 + 1 AS firm_id, transaction_id, customer_id, program_id, trx_state_id, is_deleted, transaction_date,
    cast(year(transaction_date)*10000 + month(transaction_date)*100 + day(transaction_date) AS INTEGER) AS timed_id_transaction,
    cast(hour(transaction_date) AS INTEGER) AS transaction_hour, amount_total, amount_after_discount,
    cast(amount_total - amount_after_discount AS decimal(18,2)) AS amount_discount,
    cast(CASE WHEN trx_state_id = 1 THEN amount_after_discount * 0.01 ELSE 0 END AS decimal(18,2)) AS amount_earned_point,
    cast(CASE WHEN trx_state_id = 1 AND l_linenumber = 3 THEN amount_after_discount * 0.05 END AS decimal(18,2)) AS amount_used_point
  FROM (
    SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_linenumber,
      cast(substring(o_orderpriority, 1, 1) AS INTEGER) - 1 AS program_id,
      CASE WHEN l_returnflag = 'R' AND l_linenumber IN (1, 2) THEN 3
           WHEN o_orderstatus = 'P' AND l_linenumber = 7 THEN 2 ELSE 1 END AS trx_state_id,
      CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS is_deleted,
      o_orderdate + to_hours(cast((l_orderkey * 7 + l_linenumber * 5) % 24 AS BIGINT)) AS transaction_date,
      cast(CASE WHEN l_returnflag = 'R' AND l_linenumber IN (1, 2) THEN -l_extendedprice ELSE l_extendedprice END AS decimal(18,2)) AS amount_total,
      cast(cast(CASE WHEN l_returnflag = 'R' AND l_linenumber IN (1, 2) THEN -l_extendedprice ELSE l_extendedprice END AS decimal(18,2))
           * (1 - cast(l_discount AS decimal(4,2))) AS decimal(18,2)) AS amount_after_discount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
),
best AS (
  SELECT cast(c_custkey / 2 AS BIGINT) % 3 + 1 AS firm_id, c_custkey AS unique_customer_id,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('+90', cast(5000000000 + c_custkey AS VARCHAR)) END AS mobile_number,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('c', cast(c_custkey AS VARCHAR), '@example.org') END AS email,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE cast(date '1935-01-01' + cast(c_custkey * 37 % 20000 AS INTEGER) AS DATE) END AS birth_date,
    CASE WHEN c_custkey % 4 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 'MARRIED' ELSE 'SINGLE' END AS marital_status,
    c_mktsegment AS occupation,
    CASE c_custkey % 3 WHEN 0 THEN 'PRIMARY' WHEN 1 THEN 'SECONDARY' ELSE 'UNIVERSITY' END AS education,
    CASE WHEN c_custkey % 10 = 0 THEN 'LEGAL' ELSE 'REAL' END AS real_legal_desc
  FROM customer WHERE c_custkey % 2 = 0
),
valid AS (
  SELECT * FROM trx WHERE is_deleted = 0 AND trx_state_id IN (1, 3)
)"""


def with_domain(*ctes: str, body: str) -> str:
    """``WITH <domain>, <ctes...> <body>``."""
    parts = [DOMAIN_CTES.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def ts(x) -> str:
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


def audit_ts(p: RunParams) -> str:
    return f"TIMESTAMP '{p.as_of.strftime('%Y-%m-%d')} 00:00:00'"


def dt(x) -> str:
    return f"DATE '{x.strftime('%Y-%m-%d')}'"


def fdays(end: str, start: str) -> str:
    """Fractional days between two timestamps."""
    return f"(cast(date_diff('microsecond', {start}, {end}) AS DOUBLE) / 86400000000.0)"


def ddays(end: str, start: str) -> str:
    return f"cast(date_diff('day', cast({start} AS DATE), cast({end} AS DATE)) AS INTEGER)"


# ---------------------------------------------------------------- RFM
def rfm_cte(p: RunParams = P, name: str = "rfm") -> str:
    today = dt(p.as_of_date)
    return f"""{name} AS (
  SELECT firm_id, unique_customer_id, kart_tip_detay, son_alv_tarih, son_iade_tarih,
    {ddays(today, '_last_any')} AS recency,
    {ddays(today, '_last_sale')} AS recency_gecerli,
    {ddays(today, '_last_ret')} AS recency_iade,
    CASE WHEN {ddays(today, '_last_ret')} <= {ddays(today, '_last_sale')} THEN 1 ELSE 0 END AS son_islem_iade,
    frequency, frequency_gecerli, frequency_iade,
    round(cast(frequency_iade AS DOUBLE) / cast(frequency AS DOUBLE), 4) AS iade_orani,
    _monetary AS monetary, _monetary_sale AS monetary_gecerli, _monetary_ret AS monetary_iade,
    CASE WHEN cast(_monetary_sale AS DOUBLE) = 0 THEN NULL
         ELSE -cast(_monetary_ret AS DOUBLE) / cast(_monetary_sale AS DOUBLE) END AS iade_ciro_orani,
    _earned AS kazanilan_tutar, _used AS harcanan_tutar,
    round(coalesce(CASE WHEN cast(_earned AS DOUBLE) = 0 THEN NULL
                        ELSE cast(_used AS DOUBLE) / cast(_earned AS DOUBLE) END, 0.0), 4) AS kazanilan_harcanan_tutar_oran,
    kazanilan_trx_cnt, harcanilan_trx_cnt
  FROM (
    SELECT c.firm_id, c.unique_customer_id, pr.program_name AS kart_tip_detay,
      max(CASE WHEN t.trx_state_id = 1 THEN t.timed_id_transaction END) AS son_alv_tarih,
      max(CASE WHEN t.trx_state_id = 3 THEN t.timed_id_transaction END) AS son_iade_tarih,
      max(cast(t.transaction_date AS DATE)) AS _last_any,
      max(CASE WHEN t.trx_state_id = 1 THEN cast(t.transaction_date AS DATE) END) AS _last_sale,
      max(CASE WHEN t.trx_state_id = 3 THEN cast(t.transaction_date AS DATE) END) AS _last_ret,
      count(t.transaction_id) AS frequency,
      count(CASE WHEN t.trx_state_id = 1 THEN t.transaction_id END) AS frequency_gecerli,
      count(CASE WHEN t.trx_state_id = 3 THEN t.transaction_id END) AS frequency_iade,
      sum(t.amount_after_discount) AS _monetary,
      sum(CASE WHEN t.trx_state_id = 1 THEN t.amount_after_discount END) AS _monetary_sale,
      sum(CASE WHEN t.trx_state_id = 3 THEN t.amount_after_discount END) AS _monetary_ret,
      sum(coalesce(t.amount_earned_point, 0)) AS _earned,
      sum(coalesce(t.amount_used_point, 0)) AS _used,
      cast(sum(CASE WHEN t.amount_earned_point > 0 THEN 1 ELSE 0 END) AS BIGINT) AS kazanilan_trx_cnt,
      cast(sum(CASE WHEN t.amount_used_point > 0 THEN 1 ELSE 0 END) AS BIGINT) AS harcanilan_trx_cnt
    FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
      JOIN prog pr ON c.firm_id = pr.firm_id AND c.program_id = pr.program_id
    GROUP BY c.firm_id, c.unique_customer_id, pr.program_name
    HAVING sum(t.amount_after_discount) > {p.min_spend}
  ) g
)"""


# ---------------------------------------------------------------- profile
def profile_cte(p: RunParams = P, name: str = "profile") -> str:
    today = dt(p.as_of_date)
    as_of = ts(p.as_of)
    we = "isodow(t.transaction_date) IN (6, 7)"
    recent = {k: ts(p.months_back(m)) for k, m in (("1_ay", 1), ("3_ay", 3), ("6_ay", 6), ("1_yil", 12))}
    parts = []
    for k, lit in recent.items():
        cond = f"date_trunc('day', t.transaction_date) >= {lit}"
        parts.append(f"count(DISTINCT CASE WHEN t.trx_state_id = 1 AND {cond} THEN t.transaction_id END) AS son_{k}_toplam_islem")
    for k, lit in recent.items():
        cond = f"date_trunc('day', t.transaction_date) >= {lit}"
        parts.append(f"cast(sum(CASE WHEN {cond} THEN t.amount_after_discount END) AS DOUBLE) / "
                     f"nullif(count(CASE WHEN {cond} THEN t.amount_after_discount END), 0) AS son_{k}_ort_ciro")
    for k, lit in recent.items():
        cond = f"date_trunc('day', t.transaction_date) >= {lit}"
        parts.append(f"sum(CASE WHEN {cond} THEN t.amount_after_discount END) AS son_{k}_toplam_ciro")
    recent_sql = ",\n      ".join(parts)
    dayparts = [("sabah", 8, 12), ("oglen", 12, 18), ("aksam", 18, 24), ("gece", 0, 8)]
    dp_cnt = ",\n      ".join(
        f"count(DISTINCT CASE WHEN t.trx_state_id = 1 AND t.transaction_hour >= {a} AND t.transaction_hour < {b} "
        f"THEN t.transaction_id END) AS {n}_alv" for n, a, b in dayparts)
    dp_rev = ",\n      ".join(
        f"sum(CASE WHEN hour(t.transaction_date) >= {a} AND hour(t.transaction_date) < {b} "
        f"THEN t.amount_after_discount ELSE 0 END) AS {n}_alisveris_ciro" for n, a, b in dayparts)
    age = (f"(date_diff('year', b.birth_date, {as_of}) - CASE WHEN month({as_of}) * 100 + day({as_of}) "
           f"< month(b.birth_date) * 100 + day(b.birth_date) THEN 1 ELSE 0 END)")
    bday = (f"make_date(year({as_of}), month(b.birth_date), CASE WHEN month(b.birth_date) = 2 AND "
            f"day(b.birth_date) = 29 THEN 28 ELSE day(b.birth_date) END)")
    return f"""{name} AS (
  SELECT a.*,
    CASE WHEN nullif(b.mobile_number, '') IS NULL THEN 0 ELSE 1 END AS cep_tel_var_mi,
    CASE WHEN nullif(b.email, '') IS NULL THEN 0 ELSE 1 END AS email_var_mi,
    CASE WHEN b.birth_date IS NULL THEN NULL WHEN month(b.birth_date) = month({as_of}) THEN 1 ELSE 0 END AS dogum_ayi_mi,
    CASE WHEN b.birth_date IS NULL THEN NULL WHEN month(b.birth_date) = month({as_of})
         AND day(b.birth_date) = day({as_of}) THEN 1 ELSE 0 END AS dogum_gunu_mu,
    CASE WHEN b.birth_date IS NULL THEN NULL
         WHEN {bday} BETWEEN {today} AND {today} + 7 THEN 'EVET' ELSE 'HAYIR' END AS dogum_haftasi_mi,
    cast({age} AS INTEGER) AS age,
    CASE WHEN {age} BETWEEN 18 AND 25 THEN '18-25' WHEN {age} BETWEEN 26 AND 35 THEN '26-35'
         WHEN {age} BETWEEN 36 AND 45 THEN '36-45' WHEN {age} BETWEEN 46 AND 55 THEN '46-55'
         WHEN {age} >= 56 THEN '56+' END AS yas_segment,
    b.gender AS cinsiyet_aciklama, b.marital_status AS medeni_hal_aciklama, b.occupation AS meslek_ad,
    b.education AS egitim_adi, b.real_legal_desc AS gercek_tuzel
  FROM (
    SELECT c.firm_id, c.unique_customer_id,
      count(CASE WHEN t.trx_state_id = 1 THEN t.transaction_id END) AS alisveris_adedi,
      sum(t.amount_after_discount) AS musteri_toplam_ciro,
      min(CASE WHEN t.trx_state_id = 1 THEN t.timed_id_transaction END) AS ilk_odeme_tarih,
      max(CASE WHEN t.trx_state_id = 1 THEN t.timed_id_transaction END) AS son_odeme_tarih,
      {ddays(today, 'min(CASE WHEN t.trx_state_id = 1 THEN cast(t.transaction_date AS DATE) END)')} AS ilk_odemeden_gecen_gun,
      count(DISTINCT CASE WHEN t.trx_state_id = 1 AND t.amount_after_discount <> t.amount_total THEN t.transaction_id END) AS indirimli_alv_sayisi,
      cast(count(DISTINCT CASE WHEN t.trx_state_id = 1 AND t.amount_after_discount <> t.amount_total THEN t.transaction_id END) AS DOUBLE)
        / cast(count(CASE WHEN t.trx_state_id = 1 THEN t.transaction_id END) AS DOUBLE) AS ind_alv_orani,
      avg(CASE WHEN t.trx_state_id = 1 AND t.amount_total <= 0 THEN 0.0
               WHEN t.trx_state_id = 1 AND t.amount_total > 0
               THEN 1.0 - cast(t.amount_after_discount AS DOUBLE) / cast(t.amount_total AS DOUBLE) END) AS ort_indirim_orani,
      {dp_cnt},
      cast(sum(CASE WHEN t.trx_state_id = 1 AND {we} THEN 1 ELSE 0 END) AS BIGINT) AS haftasonu_alv,
      cast(sum(CASE WHEN t.trx_state_id = 1 AND NOT ({we}) THEN 1 ELSE 0 END) AS BIGINT) AS haftaici_alv,
      {dp_rev},
      sum(CASE WHEN {we} THEN t.amount_after_discount ELSE 0 END) AS haftasonu_alv_ciro,
      sum(CASE WHEN NOT ({we}) THEN t.amount_after_discount ELSE 0 END) AS haftaici_alv_ciro,
      {recent_sql}
    FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
      JOIN prog pr ON c.firm_id = pr.firm_id AND c.program_id = pr.program_id
    WHERE t.timed_id_transaction >= {p.profile_key}
    GROUP BY c.firm_id, c.unique_customer_id
    HAVING count(CASE WHEN t.trx_state_id = 1 THEN t.transaction_id END) > 0
  ) a JOIN best b ON a.firm_id = b.firm_id AND a.unique_customer_id = b.unique_customer_id
)"""


def all_data_cte(name: str = "all_data") -> str:
    return f"""{name} AS (
  SELECT pf.*, r.son_alv_tarih, r.son_iade_tarih, r.kart_tip_detay, r.recency, r.recency_gecerli, r.recency_iade,
    r.son_islem_iade, r.frequency, r.frequency_gecerli, r.frequency_iade, r.iade_orani, r.monetary,
    r.monetary_gecerli, r.monetary_iade, r.iade_ciro_orani, r.kazanilan_tutar, r.harcanan_tutar,
    r.kazanilan_harcanan_tutar_oran, r.kazanilan_trx_cnt, r.harcanilan_trx_cnt
  FROM rfm r JOIN profile pf ON r.firm_id = pf.firm_id AND r.unique_customer_id = pf.unique_customer_id
)"""


# ---------------------------------------------------------------- segments
def _parse_key(col: str) -> str:
    return f"cast(try_strptime(lpad(cast({col} AS VARCHAR), 8, '0'), '%Y%m%d') AS DATE)"


def segments_ctes(p: RunParams = P) -> list[str]:
    from datetime import timedelta
    act = ts(p.as_of - timedelta(days=p.active_days))
    risk = ts(p.as_of - timedelta(days=p.risk_days))
    new = ts(p.as_of - timedelta(days=p.new_days))

    def sq(x):
        return f"CASE WHEN {x} >= 0 THEN sqrt({x}) END"

    def ebin(x, lo, hi, k):
        mid = (k + 1) // 2
        return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {hi} = {lo} THEN {mid} "
                f"ELSE least(greatest(1, cast(ceil(({x} - {lo}) * {float(k)} / ({hi} - {lo})) AS INTEGER)), {k}) END")

    mon, frq = "cast(b.monetary AS DOUBLE)", "cast(b.frequency AS DOUBLE)"
    seg_base = f"""seg_base AS (
  SELECT * FROM (SELECT a.*, {_parse_key('son_alv_tarih')} AS son_alv_dt, {_parse_key('ilk_odeme_tarih')} AS ilk_odeme_dt
                 FROM all_data a) WHERE son_alv_dt IS NOT NULL AND ilk_odeme_dt IS NOT NULL
)"""
    seg_stats = f"""seg_stats AS (
  SELECT firm_id,
    min(cast(monetary AS DOUBLE)) AS mon_min, max(cast(monetary AS DOUBLE)) AS mon_max,
    min(cast(frequency AS DOUBLE)) AS frq_min, max(cast(frequency AS DOUBLE)) AS frq_max,
    min(CASE WHEN frequency > 1 THEN cast(frequency AS DOUBLE) END) AS frq2_min,
    max(CASE WHEN frequency > 1 THEN cast(frequency AS DOUBLE) END) AS frq2_max,
    avg({sq('cast(monetary AS DOUBLE)')}) AS mon_sqrt_mean, stddev_samp({sq('cast(monetary AS DOUBLE)')}) AS mon_sqrt_std,
    avg({sq('cast(frequency AS DOUBLE)')}) AS frq_sqrt_mean, stddev_samp({sq('cast(frequency AS DOUBLE)')}) AS frq_sqrt_std,
    quantile_cont(cast(ind_alv_orani AS DOUBLE), 0.5) AS ind_med,
    quantile_cont(cast(ort_indirim_orani AS DOUBLE), 0.5) AS ort_med
  FROM seg_base GROUP BY firm_id
)"""
    mlabels = "['low', 'modest', 'middle', 'high', 'very high']"
    flabels = "['rare', 'medium', 'frequent']"
    seg1 = f"""seg1 AS (
  SELECT b.*,
    CASE WHEN cast(b.ilk_odeme_dt AS TIMESTAMP) >= {new} THEN 'New Customer'
         WHEN cast(b.son_alv_dt AS TIMESTAMP) >= {risk} AND cast(b.son_alv_dt AS TIMESTAMP) < {act} THEN 'Active - at risk'
         WHEN cast(b.son_alv_dt AS TIMESTAMP) >= {act} THEN 'Active Customer'
         ELSE 'Passive Customer' END AS recency_segment,
    CASE WHEN {sq(mon)} > s.mon_sqrt_mean + 3.0 * s.mon_sqrt_std THEN s.mon_sqrt_mean + 3.0 * s.mon_sqrt_std
         ELSE {sq(mon)} END AS monetary_sqrt,
    CASE WHEN {sq(frq)} > s.frq_sqrt_mean + 3.0 * s.frq_sqrt_std THEN s.frq_sqrt_mean + 3.0 * s.frq_sqrt_std
         ELSE {sq(frq)} END AS frequency_sqrt,
    CASE WHEN s.mon_max - s.mon_min = 0 THEN 0.0 ELSE ({mon} - s.mon_min) / (s.mon_max - s.mon_min) END AS monetary_scaled,
    CASE WHEN s.frq_max - s.frq_min = 0 THEN 0.0 ELSE ({frq} - s.frq_min) / (s.frq_max - s.frq_min) END AS frequency_scaled,
    {mlabels}[{ebin(mon, 's.mon_min', 's.mon_max', 5)}] AS monetary_segment,
    CASE WHEN b.frequency = 1 THEN 'single purchase'
         WHEN b.frequency > 1 THEN {flabels}[{ebin(frq, 's.frq2_min', 's.frq2_max', 3)}] END AS frequency_segment,
    CASE WHEN b.ind_alv_orani > s.ind_med THEN 'discount sensitive' ELSE 'discount insensitive' END AS indirim_duyarli_segment,
    CASE WHEN b.ort_indirim_orani > s.ort_med THEN 'high expectation' ELSE 'standard expectation' END AS indirim_beklentisi_segment,
    greatest(cast(date_diff('day', b.ilk_odeme_dt, b.son_alv_dt) AS INTEGER), 1) AS customer_lifespan,
    cast(b.musteri_toplam_ciro AS DOUBLE) / cast(b.alisveris_adedi AS DOUBLE) AS avg_purchase_value,
    cast(b.alisveris_adedi AS DOUBLE) AS avg_purchase_frequency_rate
  FROM seg_base b JOIN seg_stats s ON b.firm_id = s.firm_id
)"""
    seg2 = """seg2 AS (
  SELECT *, round_even(avg_purchase_value * avg_purchase_frequency_rate * (cast(customer_lifespan AS DOUBLE) / 365.0), 0) AS clv
  FROM seg1
)"""
    clv_q = """clv_q AS (
  SELECT firm_id,
    quantile_cont(clv, 0.3) AS clv_q30, quantile_cont(clv, 0.5) AS clv_q50, quantile_cont(clv, 0.8) AS clv_q80,
    quantile_cont(avg_purchase_value, 0.3) AS aov_q30, quantile_cont(avg_purchase_value, 0.5) AS aov_q50,
    quantile_cont(avg_purchase_value, 0.8) AS aov_q80,
    quantile_cont(avg_purchase_frequency_rate, 0.3) AS freq_q30, quantile_cont(avg_purchase_frequency_rate, 0.5) AS freq_q50,
    quantile_cont(avg_purchase_frequency_rate, 0.8) AS freq_q80,
    quantile_cont(cast(customer_lifespan AS DOUBLE), 0.3) AS life_q30, quantile_cont(cast(customer_lifespan AS DOUBLE), 0.5) AS life_q50,
    quantile_cont(cast(customer_lifespan AS DOUBLE), 0.8) AS life_q80
  FROM seg2 GROUP BY firm_id
)"""
    seg = """seg AS (
  SELECT s.*,
    CASE WHEN s.avg_purchase_frequency_rate = 1 THEN 'One-time Buyer'
         WHEN s.clv > q.clv_q80 AND s.avg_purchase_value > q.aov_q80 THEN 'VIP Customer'
         WHEN s.clv > q.clv_q50 AND s.avg_purchase_frequency_rate > q.freq_q50 THEN 'Loyal Customer'
         WHEN s.clv >= q.clv_q50 AND s.customer_lifespan >= q.life_q50 THEN 'Potential Growth Customer'
         ELSE 'at Risk' END AS clv_segment
  FROM seg2 s JOIN clv_q q ON s.firm_id = q.firm_id
)"""
    return [rfm_cte(p), profile_cte(p), all_data_cte(), seg_base, seg_stats, seg1, seg2, clv_q, seg]


def money_ratio_2dp_sql(num: str, den: str) -> str:
    cents = f"cast(cast({num} AS decimal(38,2)) * 100 AS BIGINT)"
    n = f"cast({den} AS BIGINT)"
    r = f"(sign({cents}) * ((abs({cents}) * 2 + {n}) // ({n} * 2)))"
    return f"cast(CASE WHEN {n} > 0 THEN cast({r} AS decimal(36,0)) * 0.01 END AS decimal(38,2))"


def analytic_customer_cte(p: RunParams = P, name: str = "ac") -> str:
    """One row per customer: first non-NULL value per P-code by program name."""
    codes = {
        "P1": "strftime(ilk_odeme_dt, '%Y%m%d')", "P2": "cast(son_odeme_tarih AS VARCHAR)",
        "P3": "cast(recency AS VARCHAR)", "P4": "cast(frequency AS VARCHAR)",
        "P5": "cast(cast(monetary AS decimal(38,2)) AS VARCHAR)", "P6": "recency_segment",
        "P7": "monetary_segment", "P8": "frequency_segment", "P9": "indirim_duyarli_segment",
        "P10": "indirim_beklentisi_segment", "P11": "cast(customer_lifespan AS VARCHAR)",
        "P12": "cast(" + money_ratio_2dp_sql("musteri_toplam_ciro", "alisveris_adedi") + " AS VARCHAR)",
        "P14": "cast(cast(clv AS BIGINT) AS VARCHAR)", "P15": "clv_segment",
    }
    inner = ", ".join(f"{e} AS {c}" for c, e in codes.items())
    outer = ", ".join(f"arg_min({c}, CASE WHEN {c} IS NOT NULL THEN kart_tip_detay END) AS {c}" for c in codes)
    return f"""{name} AS (
  SELECT firm_id, unique_customer_id, {outer}
  FROM (SELECT firm_id, unique_customer_id, kart_tip_detay, {inner} FROM seg) x
  GROUP BY firm_id, unique_customer_id
)"""


# ---------------------------------------------------------------- churn
def exact_avg(x: str) -> str:
    """AVG of a decimal(18,2) column rounded half-up to 6 decimals, exactly (Spark's decimal AVG)."""
    s = f"cast(sum({x}) * 100 AS HUGEINT)"
    n = f"cast(count({x}) AS HUGEINT)"
    q = f"(sign({s}) * ((abs({s}) * 20000 + {n}) // ({n} * 2)))"
    return f"cast(cast({q} AS DECIMAL(38,0)) * 0.000001 AS DECIMAL(38,6))"


def churn_ctes(p: RunParams = P, mode: str = "train", sfx: str = "") -> list[str]:
    ref = ts(p.churn_cutoff if mode == "train" else p.as_of)
    cmp = "<" if mode == "train" else "<="
    fx = f"""fx{sfx} AS (
  SELECT t.*, c.unique_customer_id FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
  WHERE t.amount_after_discount IS NOT NULL AND t.transaction_date {cmp} {ref} AND c.is_deleted = 0
)"""
    cbase = f"""cbase{sfx} AS (
  SELECT unique_customer_id, program_id, program_name, firm_id, first_transaction_date, last_transaction_date,
    total_transactions, total_spent, avg_spent, max_spent, min_spent,
    {fdays(ref, 'last_transaction_date')} AS days_since_last_transaction,
    {fdays('last_transaction_date', 'first_transaction_date')} AS customer_lifetime
  FROM (
    SELECT x.unique_customer_id, x.firm_id, x.program_id, pr.program_name,
      min(x.transaction_date) AS first_transaction_date, max(x.transaction_date) AS last_transaction_date,
      count(x.transaction_id) AS total_transactions, sum(x.amount_after_discount) AS total_spent,
      {exact_avg('x.amount_after_discount')} AS avg_spent, max(x.amount_after_discount) AS max_spent,
      min(x.amount_after_discount) AS min_spent
    FROM fx{sfx} x LEFT JOIN prog pr ON x.firm_id = pr.firm_id AND x.program_id = pr.program_id
    GROUP BY x.unique_customer_id, x.firm_id, x.program_id, pr.program_name
    HAVING count(x.transaction_id) > {p.churn_min_transactions} AND sum(x.amount_after_discount) > {p.churn_min_spend}
  ) g
)"""
    lagged = f"""lagged{sfx} AS (
  SELECT *, lag(transaction_date) OVER (PARTITION BY firm_id, unique_customer_id ORDER BY transaction_date, transaction_id,
    amount_after_discount, program_id, amount_discount NULLS FIRST, amount_used_point NULLS FIRST,
    amount_earned_point NULLS FIRST) AS previous_transaction_date
  FROM fx{sfx}
)"""
    feats = f"""feats{sfx} AS (
  SELECT firm_id, unique_customer_id, program_id, count(transaction_date) AS distinct_transactions,
    cast(sum(date_diff('microsecond', previous_transaction_date, transaction_date)) AS DOUBLE)
      / nullif(count(previous_transaction_date) * 86400000000.0, 0) AS avg_days_between_transactions,
    quantile_cont(cast(amount_after_discount AS DOUBLE), 0.5) AS median_basket_size,
    coalesce(stddev_samp(cast(amount_after_discount AS DOUBLE)),
             CASE WHEN count(amount_after_discount) = 1 THEN 0.0 END) AS basket_size_stddev,
    sum(CASE WHEN amount_discount > 0 THEN amount_discount ELSE 0 END) AS total_discount_earned,
    count(CASE WHEN amount_discount > 0 THEN 1 END) AS discounted_transactions,
    sum(CASE WHEN amount_used_point > 0 THEN amount_used_point ELSE 0 END) AS total_used_point,
    sum(CASE WHEN amount_earned_point > 0 THEN amount_earned_point ELSE 0 END) AS total_earned_point,
    count(CASE WHEN amount_used_point > 0 THEN 1 END) AS point_used_transactions
  FROM lagged{sfx} GROUP BY firm_id, unique_customer_id, program_id
)"""
    out = [fx, cbase, lagged, feats]
    if mode == "train":
        post = f"""post AS (
  SELECT c.firm_id, c.unique_customer_id, t.program_id, count(t.transaction_id) AS transactions_after_cutoff
  FROM valid t JOIN cust c ON t.firm_id = c.firm_id AND t.customer_id = c.customer_id
  WHERE t.transaction_date >= {ref} GROUP BY c.firm_id, c.unique_customer_id, t.program_id
)"""
        ds = f"""ds AS (
  SELECT b.unique_customer_id, b.program_id, b.program_name, b.firm_id, b.first_transaction_date,
    b.last_transaction_date AS last_transaction_before_cutoff, b.total_transactions, b.total_spent, b.avg_spent,
    b.max_spent, b.min_spent, b.days_since_last_transaction, b.customer_lifetime,
    coalesce(po.transactions_after_cutoff, 0) AS transactions_after_cutoff,
    CASE WHEN coalesce(po.transactions_after_cutoff, 0) = 0 THEN 1 ELSE 0 END AS is_churn,
    f.distinct_transactions, f.avg_days_between_transactions, f.median_basket_size, f.basket_size_stddev,
    f.total_discount_earned, f.discounted_transactions, f.total_used_point, f.total_earned_point,
    f.point_used_transactions
  FROM cbase{sfx} b
  LEFT JOIN post po ON b.firm_id = po.firm_id AND b.unique_customer_id = po.unique_customer_id AND b.program_id = po.program_id
  LEFT JOIN feats{sfx} f ON b.firm_id = f.firm_id AND b.unique_customer_id = f.unique_customer_id AND b.program_id = f.program_id
)"""
        train = f"""train AS (
  SELECT * FROM ds WHERE is_churn = 0 OR (is_churn = 1 AND days_since_last_transaction <= {p.churn_threshold})
)"""
        out += [post, ds, train]
    else:
        pred = f"""pred AS (
  SELECT b.*, f.distinct_transactions, f.avg_days_between_transactions, f.median_basket_size,
    f.basket_size_stddev, f.total_discount_earned, f.discounted_transactions, f.total_used_point,
    f.total_earned_point, f.point_used_transactions, 0 AS is_churn
  FROM cbase{sfx} b
  LEFT JOIN feats{sfx} f ON b.firm_id = f.firm_id AND b.unique_customer_id = f.unique_customer_id AND b.program_id = f.program_id
)"""
        out += [pred]
    return out


# ---------------------------------------------------------------- churn model
ROUND_COLS = ["total_transactions", "total_spent", "avg_spent", "max_spent", "min_spent",
              "days_since_last_transaction", "customer_lifetime", "distinct_transactions",
              "avg_days_between_transactions", "median_basket_size", "basket_size_stddev",
              "total_discount_earned", "discounted_transactions", "total_used_point", "total_earned_point",
              "point_used_transactions"]


def outlier_ctes(k: float = 3.0, ratio: float = 0.01, keys=("firm_id", "program_id", "is_churn"),
                 rows: str = "train") -> list[str]:
    """Statistics of ``train`` per ``keys``, applied to ``rows``."""
    on = ", ".join(keys)
    l_on = ", ".join(f"l.{c}" for c in keys)
    s_on = ", ".join(f"s.{c}" for c in keys)

    def same(a, b):
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)

    casts = ", ".join(f"cast({c} AS DOUBLE) AS {c}" for c in ROUND_COLS)
    lng = f"""olong AS (
  UNPIVOT (SELECT {on}, {casts} FROM train)
  ON {', '.join(ROUND_COLS)} INTO NAME "column" VALUE value
)"""
    oq = f"""oq AS (
  SELECT {on}, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM olong WHERE NOT isnan(value) GROUP BY {on}, "column"
)"""
    oflag = f"""oflag AS (
  SELECT {l_on}, l."column", first(q.q1) AS q1, first(q.q3) AS q3,
    avg(CASE WHEN l.value < q.q1 - {k} * (q.q3 - q.q1) OR l.value > q.q3 + {k} * (q.q3 - q.q1) THEN 1.0 ELSE 0.0 END) AS outlier_ratio,
    count(*) AS n_values,
    avg(CASE WHEN l.value < q.q1 - {k} * (q.q3 - q.q1) OR l.value > q.q3 + {k} * (q.q3 - q.q1) THEN 1.0 ELSE 0.0 END) > {ratio} AS flagged
  FROM olong l JOIN oq q ON {same("l", "q")}
    AND l."column" = q."column"
  GROUP BY {l_on}, l."column"
)"""
    ostat = f"""ostat AS (
  SELECT {l_on}, l."column",
    avg(CASE WHEN l.value >= 0 THEN sqrt(l.value) END) + 3.0 * stddev_samp(CASE WHEN l.value >= 0 THEN sqrt(l.value) END) AS cap
  FROM olong l GROUP BY {l_on}, l."column"
)"""
    caps = ", ".join(
        f"bool_or(s.\"column\" = '{c}') AS f_{c}, max(CASE WHEN s.\"column\" = '{c}' THEN s.cap END) AS t_{c}"
        for c in ROUND_COLS)
    owide = f"""owide AS (
  SELECT {s_on}, {caps}
  FROM ostat s JOIN oflag f ON {same("s", "f")}
    AND s."column" = f."column" AND f.outlier_ratio > {ratio}
  GROUP BY {s_on}
)"""

    def repl(c):
        v = f"cast(t.{c} AS DOUBLE)"
        sq = f"(CASE WHEN {v} >= 0 THEN sqrt({v}) END)"
        return f"CASE WHEN w.f_{c} THEN (CASE WHEN {sq} > w.t_{c} THEN w.t_{c} ELSE {sq} END) ELSE {v} END AS {c}"

    wins = f"""wins AS (
  SELECT t.unique_customer_id, t.program_id, t.firm_id, t.is_churn, {', '.join(repl(c) for c in ROUND_COLS)}
  FROM {rows} t LEFT JOIN owide w ON {same("t", "w")}
)"""
    return [lng, oq, oflag, ostat, owide, wins]


def round_even_int(x: str) -> str:
    return f"cast(round_even(coalesce(cast({x} AS DOUBLE), 0.0), 0) AS INTEGER)"


def stand_in(x: str = "unique_customer_id") -> str:
    return f"(cast({x} * 7919 % 1000 AS DOUBLE) / 1000.0)"


def risk_sql(prob: str, p: RunParams = P) -> str:
    return (f"CASE WHEN {prob} < {p.risk_medium} THEN 'low' WHEN {prob} >= {p.risk_medium} AND {prob} < {p.risk_high} "
            f"THEN 'medium' WHEN {prob} >= {p.risk_high} THEN 'high' ELSE 'unknown' END")


def scored_pred_cte(p: RunParams = P) -> str:
    rounded = ", ".join(f"{round_even_int(c)} AS {c}" for c in ROUND_COLS)
    return f"""spred AS (
  SELECT unique_customer_id, program_id, firm_id, {rounded}, churn_prob,
    CASE WHEN churn_prob >= {p.score_threshold} THEN 'CHURN' ELSE 'CHURN RİSKİ YOK' END AS is_churn_label,
    {risk_sql('churn_prob', p)} AS churn_class
  FROM (SELECT *, {stand_in()} AS churn_prob FROM pred) x
)"""


# ---------------------------------------------------------------- firm KPIs / insight
def pct_sql(n: str, t: str, d: int = 1) -> str:
    s = 10 ** d
    return (f"CASE WHEN ({t}) = 0 THEN NULL ELSE sign({n}) * floor((200 * {s} * abs({n}) + ({t})) / (2.0 * ({t}))) "
            f"/ {float(s)} END")


LY_COUNTS = [("new_customer", "P6", "New Customer"), ("active_customer", "P6", "Active Customer"),
             ("one_time_customer", "P15", "One-time Buyer"), ("vip_customer", "P15", "VIP Customer"),
             ("loyal_customer", "P15", "Loyal Customer"),
             ("potential_growth_customer", "P15", "Potential Growth Customer"),
             ("at_risk_customer", "P6", "Active - at risk"), ("churn_risk_customer", "P15", "at Risk")]
MEDIANS = [("median_recency", "P3"), ("median_frequency", "P4"), ("median_monetary_value", "P5"),
           ("median_customer_lifespan_value", "P11"), ("median_avg_purchase_value", "P12"),
           ("median_clv_value", "P14")]


def kpi_ctes(p: RunParams = P) -> list[str]:
    ly_cut = ts(p.months_back(12))
    tot = f"""ktot AS (
  SELECT firm_id, cast(year(min_p1) AS INTEGER) AS earliest_trn_year, cast(month(min_p1) AS INTEGER) AS earliest_trn_month,
    total_customers, total_vip_customer_count, total_loyal_customer_count, total_one_time_customer_count, _total_at_risk,
    {pct_sql('total_vip_customer_count', 'total_customers')} AS total_vip_customer_pct,
    {pct_sql('total_loyal_customer_count', 'total_customers')} AS total_loyal_customer_pct,
    {pct_sql('total_one_time_customer_count', 'total_customers')} AS total_one_time_customer_pct
  FROM (SELECT firm_id, try_strptime(min(P1), '%Y%m%d') AS min_p1, count(*) AS total_customers,
      count(CASE WHEN P15 = 'VIP Customer' THEN 1 END) AS total_vip_customer_count,
      count(CASE WHEN P15 = 'Loyal Customer' THEN 1 END) AS total_loyal_customer_count,
      count(CASE WHEN P15 = 'One-time Buyer' THEN 1 END) AS total_one_time_customer_count,
      count(CASE WHEN P15 = 'at Risk' THEN 1 END) AS _total_at_risk
    FROM ac GROUP BY firm_id) g
)"""
    ly_rows = f"""lyc AS (
  SELECT * FROM ac WHERE cast(try_strptime(P2, '%Y%m%d') AS TIMESTAMP) >= {ly_cut}
)"""
    cnts = ", ".join(f"count(CASE WHEN {c} = '{lab}' THEN 1 END) AS {n}_count" for n, c, lab in LY_COUNTS)
    pcts = ", ".join(f"{pct_sql(n + '_count', 'customer_count')} AS {n}_pct" for n, _, _ in LY_COUNTS)
    meds = ", ".join(f"cast(round(quantile_cont(try_cast({c} AS DOUBLE), 0.5), 3) AS DECIMAL(38,3)) AS {n}"
                     for n, c in MEDIANS)
    ly = f"""kly AS (
  SELECT *, {pcts} FROM (SELECT firm_id, count(*) AS customer_count, {cnts}, {meds} FROM lyc GROUP BY firm_id) g
)"""
    kpis = f"""kpis AS (
  SELECT t.firm_id, t.earliest_trn_year, t.earliest_trn_month, t.total_customers, t.total_vip_customer_count,
    t.total_vip_customer_pct, t.total_loyal_customer_count, t.total_loyal_customer_pct,
    t.total_one_time_customer_count, t.total_one_time_customer_pct,
    l.churn_risk_customer_count AS total_churn_risk_customer_count,
    t._total_at_risk - l.churn_risk_customer_count AS total_churned_customer_count,
    l.customer_count AS last_year_customer_count,
    {', '.join('l.' + n for n, _ in MEDIANS)},
    {', '.join(f'l.{n}_count, l.{n}_pct' for n, _, _ in LY_COUNTS)},
    {pct_sql('l.active_customer_count - l.one_time_customer_count', 'l.active_customer_count', 2)} AS one_time_to_active_conversion_rate,
    {pct_sql('l.active_customer_count', 'l.customer_count', 2)} AS retention_ratio,
    {pct_sql('l.new_customer_count', 'l.active_customer_count', 2)} AS new_customer_contribution_pct,
    round(cast(l.churn_risk_customer_count AS DECIMAL(20,0)) * l.median_avg_purchase_value, 2) AS lost_revenue_from_churn_risk,
    round(cast(l.active_customer_count AS DECIMAL(20,0)) * l.median_avg_purchase_value, 2) AS projected_revenue_from_active_customers
  FROM ktot t LEFT JOIN kly l ON t.firm_id = l.firm_id
)"""
    derived = """kder AS (
  SELECT *, total_churned_customer_count AS churned_customer_count,
    round_even(cast(total_churn_risk_customer_count AS DOUBLE) / last_year_customer_count * 100, 1) AS total_churn_risk_customer_pct,
    round_even(cast(total_churned_customer_count AS DOUBLE) / total_customers * 100, 1) AS actual_churn_rate,
    cast(round_even(cast(median_monetary_value AS DOUBLE), 0) AS BIGINT) AS median_monetary_value_int,
    cast(round_even(cast(median_avg_purchase_value AS DOUBLE), 0) AS BIGINT) AS median_avg_purchase_value_int,
    cast(round_even(cast(lost_revenue_from_churn_risk AS DOUBLE), 0) AS BIGINT) AS lost_revenue_int,
    cast(round_even(cast(projected_revenue_from_active_customers AS DOUBLE), 0) AS BIGINT) AS projected_revenue_int,
    round_even(cast(new_customer_contribution_pct AS DOUBLE), 1) AS new_customer_contribution_pct_1,
    round_even(cast(retention_ratio AS DOUBLE), 1) AS retention_ratio_1
  FROM kpis
)"""
    rules = """krules AS (
  SELECT *,
    CASE WHEN retention_ratio_1 > 80 THEN 'strong' WHEN retention_ratio_1 < 50 THEN 'weak' ELSE 'none' END AS rule_retention,
    CASE WHEN vip_customer_pct < 10 THEN 'low' ELSE 'high' END AS rule_vip,
    CASE WHEN one_time_to_active_conversion_rate > 50 THEN 'high' ELSE 'low' END AS rule_conversion,
    CASE WHEN potential_growth_customer_pct > total_churn_risk_customer_pct THEN 'growth' ELSE 'risk' END AS rule_growth
  FROM kder
)"""
    return [ly_rows, tot, ly, kpis, derived, rules]


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fill_sql(template: str, **exprs: str) -> str:
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(_lit(template[pos:m.start()]))
        parts.append(f"coalesce(cast({exprs[m.group(1)]} AS VARCHAR), 'nan')")
        pos = m.end()
    if pos < len(template):
        parts.append(_lit(template[pos:]))
    return "concat(" + ", ".join(parts) + ")"


def thousands_sql(x: str) -> str:
    return f"format('{{:,}}', cast({x} AS BIGINT))"


def num_text_sql(x: str, d: int = 2) -> str:
    s = f"format('{{:.{d}f}}', cast({x} AS DOUBLE))"
    return f"regexp_replace(regexp_replace({s}, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"


def suffix_sql(t: str) -> str:
    from ..functions.text import SUFFIX_BY_DIGIT, SUFFIX_BY_TENS, SUFFIX_OTHER
    d = " ".join(f"WHEN {_lit(str(k))} THEN {_lit(v)}" for k, v in SUFFIX_BY_DIGIT.items())
    tens = " ".join(f"WHEN {_lit(str(k))} THEN {_lit(v)}" for k, v in SUFFIX_BY_TENS.items())
    return (f"CASE WHEN right({t}, 1) <> '0' THEN (CASE right({t}, 1) {d} END) "
            f"ELSE coalesce(CASE {t} {tens} END, {_lit(SUFFIX_OTHER)}) END")


def pct_suffix_sql(x: str) -> str:
    t = num_text_sql(x)
    return f"concat('%', {t}, {suffix_sql(t)})"


def insight_sql_expr() -> str:
    from ..functions.text import MONTHS_TR
    from ..operators import insight as I
    months = "[" + ", ".join(_lit(m) for m in MONTHS_TR) + "]"
    firm = "firm_name"
    intro = fill_sql(I.T_INTRO, firm=firm, year="earliest_trn_year", month=f"{months}[earliest_trn_month]",
                     total=thousands_sql("total_customers"), ly=thousands_sql("last_year_customer_count"),
                     active_pct=pct_suffix_sql("active_customer_pct"), projected=thousands_sql("projected_revenue_int"),
                     retention_pct=pct_suffix_sql("retention_ratio_1"))
    ret = (f"CASE WHEN rule_retention = 'strong' THEN {_lit(I.T_RET_STRONG)} WHEN rule_retention = 'weak' "
           f"THEN {_lit(I.T_RET_WEAK)} ELSE '' END")
    rfm = fill_sql(I.T_RFM, recency=num_text_sql("median_recency"), frequency=num_text_sql("median_frequency"),
                   monetary=thousands_sql("median_monetary_value_int"))
    segs = fill_sql(I.T_SEGMENTS, firm=firm, vip_pct=pct_suffix_sql("vip_customer_pct"))
    vip = f"CASE WHEN rule_vip = 'low' THEN {_lit(I.T_VIP_LOW)} ELSE {_lit(I.T_VIP_HIGH)} END"
    loyal = fill_sql(I.T_LOYAL, loyal_pct=pct_suffix_sql("loyal_customer_pct"))
    one = fill_sql(I.T_ONE_TIME, firm=firm, one_time_pct=pct_suffix_sql("one_time_customer_pct"))
    conv_t = num_text_sql("one_time_to_active_conversion_rate")
    conv = (f"CASE WHEN rule_conversion = 'high' THEN {fill_sql(I.T_CONV_HIGH, conversion=conv_t)} "
            f"ELSE {fill_sql(I.T_CONV_LOW, conversion=conv_t)} END")
    risk = fill_sql(I.T_CHURN_RISK, churn_risk_pct=pct_suffix_sql("total_churn_risk_customer_pct"),
                    lost=thousands_sql("lost_revenue_int"))
    churned = fill_sql(I.T_CHURNED, churned=thousands_sql("churned_customer_count"),
                       churned_pct=num_text_sql("actual_churn_rate"))
    growth = fill_sql(I.T_GROWTH, growth_pct=pct_suffix_sql("potential_growth_customer_pct"))
    g2 = f"CASE WHEN rule_growth = 'growth' THEN {fill_sql(I.T_GROWTH_UP, firm=firm)} ELSE {_lit(I.T_GROWTH_DOWN)} END"
    return f"concat({intro}, {ret}, {rfm}, {segs}, {vip}, {loyal}, {one}, {conv}, {risk}, {churned}, {growth}, {g2})"


def churn_p_codes_cte(p: RunParams = P, name: str = "acc") -> str:
    codes = {
        "P13": "cast(avg_days_between_transactions AS VARCHAR)", "P16": "cast(days_since_last_transaction AS VARCHAR)",
        "P17": "cast(customer_lifetime AS VARCHAR)", "P18": "cast(distinct_transactions AS VARCHAR)",
        "P19": "cast(avg_spent AS VARCHAR)", "P20": "cast(max_spent AS VARCHAR)",
        "P21": "cast(total_used_point AS VARCHAR)", "P22": "cast(churn_prob AS VARCHAR)",
        "P23": "is_churn_label", "P24": "churn_class", "P25": "cast(program_id AS VARCHAR)",
        "P26": f"cast(cast({p.run_id} AS BIGINT) AS VARCHAR)",
    }
    inner = ", ".join(f"{e} AS {c}" for c, e in codes.items())
    outer = ", ".join(f"arg_min({c}, CASE WHEN {c} IS NOT NULL THEN program_id END) AS {c}" for c in codes)
    return f"""{name} AS (
  SELECT firm_id, unique_customer_id, {outer}
  FROM (SELECT firm_id, unique_customer_id, program_id, {inner} FROM spred) x
  GROUP BY firm_id, unique_customer_id
)"""
