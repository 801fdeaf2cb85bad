"""Churn feature sets: customer base, transaction features, outcome label,
training set (with the random cap) and prediction set.

Keys: transactions are mapped to the unique customer first, so features, base
and label share the grain (firm, unique customer, transaction's program).

A tenant can have its own churn threshold in days (``thresholds``: firm_id,
churn_threshold, a row per tenant); the others take that of the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import avg_frac_days, frac_days
from ..functions.stats import stddev_oracle
from ..params import DEFAULT, RunParams, ts_lit
from ..session import cut_lineage, written
from .joins import broadcast_checked
from .ranking import HOT_ROWS, lag, lag_in_order, row_positions, rows_per_group, split_hot
from .rfm import valid_transactions
from .selection import median, median_of_ranks, with_ranks

KEYS = ["firm_id", "unique_customer_id", "program_id"]
DIM_ROWS = 100_000

BASE_COLS = ["unique_customer_id", "program_id", "program_name", "firm_id", "first_transaction_date",
             "last_transaction_date", "total_transactions", "total_spent", "avg_spent", "max_spent",
             "min_spent", "days_since_last_transaction", "customer_lifetime"]
FEATURE_COLS = ["distinct_transactions", "avg_days_between_transactions", "median_basket_size",
                "basket_size_stddev", "total_discount_earned", "discounted_transactions", "total_used_point",
                "total_earned_point", "point_used_transactions"]


def with_reference(df: DataFrame, params: RunParams = DEFAULT, mode: str = "train",
                   thresholds: DataFrame | None = None) -> DataFrame:
    """Adds ``_days``, the churn threshold of the row's tenant, and ``_ref``, the time its measures
    refer to: the cut-off (train) or as-of (predict). Literals, unless tenants have their own."""
    if thresholds is None:
        ref = params.churn_cutoff if mode == "train" else params.as_of
        return df.withColumns({"_days": F.lit(params.churn_threshold), "_ref": ts_lit(ref)})
    own = broadcast_checked(thresholds.select("firm_id", F.col("churn_threshold").cast("int").alias("_own")), DIM_ROWS)
    out = (df.join(own, "firm_id", "left")
           .withColumn("_days", F.coalesce("_own", F.lit(params.churn_threshold))).drop("_own"))
    cutoff = F.timestamp_add("DAY", -F.col("_days"), params.as_of_col)
    return out.withColumn("_ref", cutoff if mode == "train" else params.as_of_col)


def feature_transactions(trx: DataFrame, cust: DataFrame, params: RunParams = DEFAULT,
                         mode: str = "train", thresholds: DataFrame | None = None) -> DataFrame:
    """Valid, priced transactions before the cut-off (train) or up to as-of (predict),
    mapped to live customers."""
    return priced_transactions(trx, params, mode, thresholds).join(live_customers(cust), ["firm_id", "customer_id"])


def live_customers(cust: DataFrame) -> DataFrame:
    return cust.where(F.col("is_deleted") == 0).select("firm_id", "customer_id", "unique_customer_id")



def priced_transactions(trx: DataFrame, params: RunParams = DEFAULT, mode: str = "train",
                        thresholds: DataFrame | None = None) -> DataFrame:
    """Valid, priced transactions before the cut-off (train) or up to as-of (predict)."""
    t = with_reference(valid_transactions(trx, require_amount=True), params, mode, thresholds)
    d = F.col("transaction_date")
    return t.where(d < F.col("_ref") if mode == "train" else d <= F.col("_ref")).drop("_days", "_ref")


def _base_aggs():
    aad = F.col("amount_after_discount")
    d = F.col("transaction_date")
    return [
        F.min(d).alias("first_transaction_date"),
        F.max(d).alias("last_transaction_date"),
        F.count("transaction_id").alias("total_transactions"),
        F.sum(aad).alias("total_spent"),
        F.avg(aad).alias("avg_spent"),
        F.max(aad).alias("max_spent"),
        F.min(aad).alias("min_spent"),
    ]


def _base_filter(params: RunParams):
    return ((F.col("total_transactions") > params.churn_min_transactions)
            & (F.col("total_spent") > F.lit(params.churn_min_spend)))


def _with_base_derived(g: DataFrame, params: RunParams, mode: str, thresholds: DataFrame | None) -> DataFrame:
    return with_reference(g, params, mode, thresholds).withColumns({
        "days_since_last_transaction": frac_days(F.col("_ref"), F.col("last_transaction_date")),
        "customer_lifetime": frac_days(F.col("last_transaction_date"), F.col("first_transaction_date")),
    })


def _feature_aggs():
    ad, used, earned = F.col("amount_discount"), F.col("amount_used_point"), F.col("amount_earned_point")
    zero = F.lit(0).cast("decimal(18,2)")
    return [
        F.count("transaction_date").alias("distinct_transactions"),
        avg_frac_days("transaction_date", "previous_transaction_date")
        .alias("avg_days_between_transactions"),
        stddev_oracle(F.col("amount_after_discount").cast("double")).alias("basket_size_stddev"),
        F.sum(F.when(ad > 0, ad).otherwise(zero)).alias("total_discount_earned"),
        F.count(F.when(ad > 0, F.lit(1))).alias("discounted_transactions"),
        F.sum(F.when(used > 0, used).otherwise(zero)).alias("total_used_point"),
        F.sum(F.when(earned > 0, earned).otherwise(zero)).alias("total_earned_point"),
        F.count(F.when(used > 0, F.lit(1))).alias("point_used_transactions"),
    ]


def customer_base(x: DataFrame, prog: DataFrame, params: RunParams = DEFAULT, mode: str = "train",
                  thresholds: DataFrame | None = None) -> DataFrame:
    """CUSTOMER_BASE: eligible (customer, program) with spend and recency measures."""
    p = broadcast_checked(prog, DIM_ROWS)
    g = x.groupBy(*KEYS).agg(*_base_aggs()).where(_base_filter(params))
    return _with_base_derived(g.join(p, ["firm_id", "program_id"], "left"), params, mode, thresholds).select(*BASE_COLS)


LAG_COLS = ["unique_customer_id", "firm_id", "transaction_date", "transaction_id", "amount_after_discount",
            "program_id", "amount_discount", "amount_used_point", "amount_earned_point"]


CUSTOMER = ["firm_id", "unique_customer_id"]
LAG = (CUSTOMER, ["transaction_date", "transaction_id", "amount_after_discount"], "transaction_date", "previous_transaction_date")


def with_previous_date(x: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Previous purchase date of the firm's same customer (any program), skew-safe lag of written rows."""
    return lag(x, *LAG, hot_rows)


def with_median(x: DataFrame, aggs: list, hot_rows: int | None = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """``aggs`` over transactions with their previous date, and the median basket, per (firm, customer, program).
    The transactions are stored ones, or their customers are ``counted`` (see :func:`ranking.split_hot`).

    Customers of at most ``hot_rows`` rows are exchanged once, by customer: the lag, the ranks
    of the amounts and the aggregate all lie within it. The others' rows are split among tasks
    by the lag in chunks and the selection by histograms. A group with a NULL key has no median.
    """
    rest, hot = split_hot(x, CUSTOMER, hot_rows, counted)
    known = F.lit(True)
    for k in KEYS:
        known = known & F.col(k).isNotNull()
    out = (with_ranks(with_previous_date(rest, None), KEYS, "amount_after_discount").groupBy(*KEYS)
           .agg(*aggs, median_of_ranks().alias("_median"))
           .withColumn("median_basket_size", F.when(known, F.col("_median"))).drop("_median"))
    if hot is None:
        return out
    if counted is not None:
        hot = written(hot, "churn-hot-transactions")
    med = median(hot, KEYS, "amount_after_discount", "median_basket_size")
    return out.unionByName(lag_in_order(hot, *LAG).groupBy(*KEYS).agg(*aggs).join(med, KEYS, "left"))


def transaction_features(x: DataFrame) -> DataFrame:
    """TRANSACTION_FEATURES per (firm, customer, program). The transactions are written once,
    as Parquet; the search for hot customers and the measures read them."""
    return features_of(written(x.select(*LAG_COLS), "churn-transactions"))


def features_of(x: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The features of stored transactions; ``hot_rows`` as in :func:`ranking.lag`."""
    return with_median(x, _feature_aggs(), hot_rows).select(*KEYS, *FEATURE_COLS)


def customer_features(x: DataFrame, prog: DataFrame, params: RunParams = DEFAULT, mode: str = "train",
                      thresholds: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """CUSTOMER_BASE joined with TRANSACTION_FEATURES, computed in one pass: base measures
    and features aggregate the same rows, so a single aggregate over the lagged frame
    gives both (the reference's left join of features onto the base). The transactions go
    straight into the exchange by customer where their customers are ``counted``; else they
    are written once, as Parquet; see :func:`with_median`."""
    x = x.select(*LAG_COLS)
    if counted is None:
        x = written(x, "churn-transactions")
    g = with_median(x, [*_base_aggs(), *_feature_aggs()], counted=counted).where(_base_filter(params))
    p = broadcast_checked(prog, DIM_ROWS)
    out = g.join(p, ["firm_id", "program_id"], "left")
    return _with_base_derived(out, params, mode, thresholds).select(*BASE_COLS, *FEATURE_COLS)


def post_cutoff_activity(trx: DataFrame, cust: DataFrame, params: RunParams = DEFAULT,
                         thresholds: DataFrame | None = None) -> DataFrame:
    """Valid transactions at/after the cut-off per (firm, customer, program) - the outcome.
    Counted per customer id before the customers are joined."""
    t = with_reference(valid_transactions(trx), params, "train", thresholds)
    per = (t.where(F.col("transaction_date") >= F.col("_ref")).groupBy("firm_id", "customer_id", "program_id")
           .agg(F.count("transaction_id").alias("_after")))
    c = cust.select("firm_id", "customer_id", "unique_customer_id")
    return per.join(c, ["firm_id", "customer_id"]).groupBy(*KEYS).agg(
        F.sum("_after").alias("transactions_after_cutoff"))


def _features_by_mode(trx: DataFrame, cust: DataFrame, prog: DataFrame, params: RunParams, mode: str,
                      thresholds: DataFrame | None = None) -> DataFrame:
    """The features of all customers before the cut-off (train) or up to as-of (predict)."""
    counted = rows_per_group(priced_transactions(trx, params, mode, thresholds), live_customers(cust),
                             ["firm_id", "customer_id"], CUSTOMER)
    x = feature_transactions(trx, cust, params, mode, thresholds)
    return customer_features(x, prog, params, mode, thresholds, counted)


def churn_dataset(trx: DataFrame, cust: DataFrame, prog: DataFrame, params: RunParams = DEFAULT,
                  thresholds: DataFrame | None = None) -> DataFrame:
    """CHURN_DATASET: base + features + outcome label (before the training filter)."""
    cf = _features_by_mode(trx, cust, prog, params, "train", thresholds).withColumnRenamed(
        "last_transaction_date", "last_transaction_before_cutoff")
    post = post_cutoff_activity(trx, cust, params, thresholds)
    n_after = F.coalesce(F.col("transactions_after_cutoff"), F.lit(0).cast("long"))
    return cf.join(post, KEYS, "left").withColumns({
        "transactions_after_cutoff": n_after,
        "is_churn": F.when(n_after == 0, 1).otherwise(0),
    })


def random_key(seed: int):
    """Reproducible uniform [0, 1) key per (firm, customer, program)."""
    h = F.xxhash64(F.col("firm_id"), F.col("unique_customer_id"), F.col("program_id"), F.lit(seed))
    return (F.pmod(h, F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52)))


def capped_sample(df: DataFrame, n: int, seed: int = 42, keys=("firm_id",)) -> DataFrame:
    """Uniform sample without replacement of exactly ``min(n, rows)`` rows per tenant: the
    rows whose random key ranks below ``n``. Ranks come from the distributed position
    operator, so no single task sorts or holds the sample."""
    keyed = cut_lineage(df.withColumn("rnd", random_key(seed)))
    ranked = row_positions(keyed, list(keys), [F.col("rnd"), F.col("unique_customer_id"), F.col("program_id")])
    return ranked.where(F.col("_rank") < F.lit(n)).drop("_rank", "_n")


def training_filter(df: DataFrame, params: RunParams = DEFAULT, thresholds: DataFrame | None = None) -> DataFrame:
    """Non-churners, and churners that bought within the threshold before the cut-off."""
    recent = F.col("days_since_last_transaction") <= F.col("_days")
    return (with_reference(df, params, "train", thresholds)
            .where((F.col("is_churn") == 0) | ((F.col("is_churn") == 1) & recent)).drop("_days", "_ref"))


def churn_training_set(trx: DataFrame, cust: DataFrame, prog: DataFrame, params: RunParams = DEFAULT,
                       max_rows: int | None = None, thresholds: DataFrame | None = None) -> DataFrame:
    """Training set: labelled rows, recently active churners only, with their random key.
    All rows, unless ``max_rows`` per tenant are asked for; the cap of the fit itself is
    applied by ``churn_model.fit_churn``."""
    ds = training_filter(churn_dataset(trx, cust, prog, params, thresholds), params, thresholds)
    if max_rows is None:
        return cut_lineage(ds.withColumn("rnd", random_key(params.seed)))
    return capped_sample(ds, max_rows, params.seed)


def churn_prediction_set(trx: DataFrame, cust: DataFrame, prog: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Prediction set: the same features up to as-of, label unknown (0)."""
    return _features_by_mode(trx, cust, prog, params, "predict").withColumn("is_churn", F.lit(0))
