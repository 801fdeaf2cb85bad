"""ANALYTICAL_PROFILE: 24-month purchase profile + demographics per unique customer,
and ANALYTIC_ALL_DATA (RFM joined with the profile).

Plan shape (see ``profile_plan_notes``):

1. filter + join transactions to the customer map (shuffle on customer_id,
   or broadcast when the customer side is small at runtime),
2. one exchange by unique customer (customers of millions of rows apart: theirs
   is by transaction too, which spreads them over tasks),
3. the ``COUNT(DISTINCT transaction_id CASE ...)`` conditions as bits of one
   integer; a window per (unique customer, transaction id) leaves each bit at
   the first row that has it, so that one aggregate on the unique customer
   (partial aggregation map-side) counts and sums everything: no ``Expand`` by
   the number of distinct aggregates and no wide row per transaction,
4. join the demographics of CUSTOMER_BEST after aggregating (instead of
   grouping by ~15 functionally dependent expressions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import age_band, birthday_this_year, completed_years, day_diff, is_weekend
from ..params import DEFAULT, RunParams, ts_lit
from .joins import broadcast_checked
from .ranking import HOT_ROWS, rows_per_group, split_hot, telling_first
from .rfm import SALE, valid_transactions

DIM_ROWS = 100_000
RECENT_MONTHS = {"1_ay": 1, "3_ay": 3, "6_ay": 6, "1_yil": 12}
DAYPARTS = {  # name: (hour_from inclusive, hour_to exclusive)
    "sabah": (8, 12),
    "oglen": (12, 18),
    "aksam": (18, 24),
    "gece": (0, 8),
}

PROFILE_MEASURES = [
    "alisveris_adedi", "musteri_toplam_ciro", "ilk_odeme_tarih", "son_odeme_tarih", "ilk_odemeden_gecen_gun",
    "indirimli_alv_sayisi", "ind_alv_orani", "ort_indirim_orani",
    "sabah_alv", "oglen_alv", "aksam_alv", "gece_alv", "haftasonu_alv", "haftaici_alv",
    "sabah_alisveris_ciro", "oglen_alisveris_ciro", "aksam_alisveris_ciro", "gece_alisveris_ciro",
    "haftasonu_alv_ciro", "haftaici_alv_ciro",
    "son_1_ay_toplam_islem", "son_3_ay_toplam_islem", "son_6_ay_toplam_islem", "son_1_yil_toplam_islem",
    "son_1_ay_ort_ciro", "son_3_ay_ort_ciro", "son_6_ay_ort_ciro", "son_1_yil_ort_ciro",
    "son_1_ay_toplam_ciro", "son_3_ay_toplam_ciro", "son_6_ay_toplam_ciro", "son_1_yil_toplam_ciro",
]
DEMOGRAPHICS = [
    "cep_tel_var_mi", "email_var_mi", "dogum_ayi_mi", "dogum_gunu_mu", "dogum_haftasi_mi", "age", "yas_segment",
    "cinsiyet_aciklama", "medeni_hal_aciklama", "meslek_ad", "egitim_adi", "gercek_tuzel",
]

SLICES = {
    "daypart_profile": ["sabah_alv", "oglen_alv", "aksam_alv", "gece_alv",
                        "sabah_alisveris_ciro", "oglen_alisveris_ciro", "aksam_alisveris_ciro",
                        "gece_alisveris_ciro"],
    "weekend_split": ["haftasonu_alv", "haftaici_alv", "haftasonu_alv_ciro", "haftaici_alv_ciro"],
    "revenue_profile": ["alisveris_adedi", "musteri_toplam_ciro", "ilk_odeme_tarih", "son_odeme_tarih",
                        "ilk_odemeden_gecen_gun"],
    "recent_activity": [f"son_{k}_{m}" for m in ("toplam_islem", "ort_ciro", "toplam_ciro")
                        for k in RECENT_MONTHS],
    "discount_profile": ["indirimli_alv_sayisi", "ind_alv_orani", "ort_indirim_orani"],
    "demographics": ["cep_tel_var_mi", "email_var_mi", "age", "yas_segment", "cinsiyet_aciklama",
                     "medeni_hal_aciklama", "meslek_ad", "egitim_adi", "gercek_tuzel"],
    "birthday_flags": ["dogum_ayi_mi", "dogum_gunu_mu", "dogum_haftasi_mi"],
}


def demographics(best: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Contact flags, birthday flags, age and band per unique customer."""
    as_of = params.as_of_col
    today = params.as_of_date_col
    b = F.col("birth_date")
    same_month = F.month(b) == F.month(as_of)
    same_day = same_month & (F.dayofmonth(b) == F.dayofmonth(as_of))
    bday = birthday_this_year(b, F.year(as_of))
    age = completed_years(as_of, b)
    return best.select(
        "firm_id", "unique_customer_id",
        F.when(F.nullif(F.col("mobile_number"), F.lit("")).isNull(), 0).otherwise(1).alias("cep_tel_var_mi"),
        F.when(F.nullif(F.col("email"), F.lit("")).isNull(), 0).otherwise(1).alias("email_var_mi"),
        F.when(b.isNull(), F.lit(None).cast("int")).when(same_month, 1).otherwise(0).alias("dogum_ayi_mi"),
        F.when(b.isNull(), F.lit(None).cast("int")).when(same_day, 1).otherwise(0).alias("dogum_gunu_mu"),
        F.when(b.isNull(), F.lit(None).cast("string"))
        .when(bday.between(today, F.date_add(today, 7)), "EVET").otherwise("HAYIR").alias("dogum_haftasi_mi"),
        age.alias("age"),
        age_band(age).alias("yas_segment"),
        F.col("gender").alias("cinsiyet_aciklama"),
        F.col("marital_status").alias("medeni_hal_aciklama"),
        F.col("occupation").alias("meslek_ad"),
        F.col("education").alias("egitim_adi"),
        F.col("real_legal_desc").alias("gercek_tuzel"),
    )


CUSTOMER = ["firm_id", "unique_customer_id"]
#: What the measures read.
MEASURED = ["transaction_id", "trx_state_id", "amount_after_discount", "amount_total", "transaction_date",
               "transaction_hour", "timed_id_transaction"]


def _money(c):
    return F.sum(c).cast("decimal(38,2)")


def _measures(params: RunParams) -> tuple[dict, list]:
    """What is counted once per transaction id (name -> condition on a row), and the aggregates of all rows."""
    sale = F.col("trx_state_id") == SALE
    aad = F.col("amount_after_discount")
    at = F.col("amount_total")
    d = F.col("transaction_date")
    hr = F.col("transaction_hour")
    dhr = F.hour(d)
    day = F.date_trunc("DAY", d)
    zero = F.lit(0).cast("decimal(18,2)")
    disc_rate = F.when(sale & (at <= 0), F.lit(0.0)).when(
        sale & (at > 0), F.lit(1.0) - aad.cast("double") / at.cast("double"))
    flags = {"indirimli_alv_sayisi": sale & (aad != at)}
    aggs = [
        F.sum(F.when(sale, 1).otherwise(0)).alias("alisveris_adedi"),
        _money(aad).alias("musteri_toplam_ciro"),
        F.min(F.when(sale, F.col("timed_id_transaction"))).alias("ilk_odeme_tarih"),
        F.max(F.when(sale, F.col("timed_id_transaction"))).alias("son_odeme_tarih"),
        F.min(F.when(sale, d.cast("date"))).alias("_first_sale_day"),
        F.sum(disc_rate).alias("_s_rate"),
        F.count(disc_rate).alias("_n_rate"),
        F.sum(F.when(sale & is_weekend(d), 1).otherwise(0)).alias("haftasonu_alv"),
        F.sum(F.when(sale & ~is_weekend(d), 1).otherwise(0)).alias("haftaici_alv"),
        _money(F.when(is_weekend(d), aad).otherwise(zero)).alias("haftasonu_alv_ciro"),
        _money(F.when(~is_weekend(d), aad).otherwise(zero)).alias("haftaici_alv_ciro"),
    ]
    for name, (lo, hi) in DAYPARTS.items():
        flags[f"{name}_alv"] = sale & (hr >= lo) & (hr < hi)
        aggs.append(_money(F.when((dhr >= lo) & (dhr < hi), aad).otherwise(zero)).alias(f"{name}_alisveris_ciro"))
    for k, mo in RECENT_MONTHS.items():
        recent = day >= ts_lit(params.months_back(mo))
        flags[f"son_{k}_toplam_islem"] = sale & recent
        aggs.append(_money(F.when(recent, aad)).alias(f"son_{k}_toplam_ciro"))
        aggs.append(F.count(F.when(recent, aad)).alias(f"_n_{k}"))
    return flags, aggs


def _profile_finish(agg: DataFrame, params: RunParams) -> DataFrame:
    derived = {
        "alisveris_adedi": F.col("alisveris_adedi").cast("long"),
        "ilk_odemeden_gecen_gun": day_diff(params.as_of_date_col, "_first_sale_day"),
        "ind_alv_orani": F.try_divide(F.col("indirimli_alv_sayisi").cast("double"), F.col("alisveris_adedi").cast("double")),
        "ort_indirim_orani": F.try_divide(F.col("_s_rate"), F.col("_n_rate").cast("double")),
    }
    for name in agg.columns:
        if name.endswith(("_alv", "_islem")) or name == "indirimli_alv_sayisi":
            derived[name] = F.col(name).cast("long")
    for k in RECENT_MONTHS:
        derived[f"son_{k}_ort_ciro"] = F.try_divide(F.col(f"son_{k}_toplam_ciro").cast("double"),
                                                    F.col(f"_n_{k}").cast("double"))
    return agg.withColumns(derived)


def purchase_profile(trx: DataFrame, cust: DataFrame, best: DataFrame, prog: DataFrame,
                     params: RunParams = DEFAULT, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """ANALYTICAL_PROFILE (45 columns) per unique customer.

    The transactions are exchanged once, by customer; the window per transaction, the aggregate and the join
    of the demographics lie within that exchange. Those of customers of more than ``hot_rows`` transactions
    are exchanged by transaction instead, which spreads them over tasks."""
    t = valid_transactions(trx).where(F.col("timed_id_transaction") >= F.lit(params.profile_key))
    # a customer without a unique one has no demographics, hence no profile
    c = cust.where(F.col("unique_customer_id").isNotNull()).select(
        "firm_id", "customer_id", "unique_customer_id", F.col("program_id").alias("cust_program_id"))
    p = broadcast_checked(prog.select("firm_id", F.col("program_id").alias("cust_program_id")), DIM_ROWS)
    x = t.join(c, ["firm_id", "customer_id"]).join(p, ["firm_id", "cust_program_id"]).select(*CUSTOMER, *MEASURED)
    counted = None if hot_rows is None else rows_per_group(t, c, ["firm_id", "customer_id"], CUSTOMER)
    rest, hot = split_hot(x, CUSTOMER, hot_rows, counted)
    out = profile_of(rest.repartition(*(F.col(k) for k in CUSTOMER)), best, params)
    return out if hot is None else out.unionByName(profile_of(hot, best, params))


def profile_of(x: DataFrame, best: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """The profile of transactions that carry their unique customer."""
    flags, aggs = _measures(params)
    bits = {name: 1 << i for i, name in enumerate(flags)}
    mask = sum((F.when(c, F.lit(bits[n])).otherwise(F.lit(0)) for n, c in flags.items()), F.lit(0))
    # a condition counts at the first row of its transaction that meets it
    earlier = (Window.partitionBy(*telling_first([*CUSTOMER, "transaction_id"])).orderBy("_met")
               .rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_met", mask).withColumn("_seen", F.coalesce(F.bit_or("_met").over(earlier), F.lit(0)))
    new = F.col("_met").bitwiseAND(F.bitwise_not("_seen"))
    agg = x.withColumn("_new", new).groupBy(*CUSTOMER).agg(
        *aggs, *[F.count_if(F.col("_new").bitwiseAND(F.lit(b)) != 0).alias(n) for n, b in bits.items()],
    ).where(F.col("alisveris_adedi") > 0)
    agg = _profile_finish(agg, params)
    demo = demographics(best, params)
    return agg.join(demo, ["firm_id", "unique_customer_id"]).select(
        "firm_id", "unique_customer_id", *PROFILE_MEASURES, *DEMOGRAPHICS)


def profile_slice(profile: DataFrame, name: str) -> DataFrame:
    """A named column slice of the profile (column pruning drops unused aggregates)."""
    return profile.select("firm_id", "unique_customer_id", *SLICES[name])


RFM_COLS = [
    "son_alv_tarih", "son_iade_tarih", "kart_tip_detay", "recency", "recency_gecerli", "recency_iade",
    "son_islem_iade", "frequency", "frequency_gecerli", "frequency_iade", "iade_orani", "monetary",
    "monetary_gecerli", "monetary_iade", "iade_ciro_orani", "kazanilan_tutar", "harcanan_tutar",
    "kazanilan_harcanan_tutar_oran", "kazanilan_trx_cnt", "harcanilan_trx_cnt",
]


def all_data(rfm: DataFrame, profile: DataFrame) -> DataFrame:
    """ANALYTIC_ALL_DATA: RFM (per program) joined with the profile on the firm's unique customer."""
    return profile.join(rfm, ["firm_id", "unique_customer_id"]).select(
        "firm_id", "unique_customer_id", *PROFILE_MEASURES, *DEMOGRAPHICS, *RFM_COLS)

