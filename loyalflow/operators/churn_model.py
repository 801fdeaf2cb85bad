"""Churn model stage: outlier detection and suppression, feature rounding,
stratified split, gradient-boosted classifier, scoring, risk classes and
binary-classification metrics.

Group statistics are computed for every (firm, program, class, column) in one
job over a long frame (unpivot), never with a driver loop over groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import pct_half_up, round_int_even
from ..params import DEFAULT, RunParams
from ..session import cut_lineage
from .churn_features import capped_sample, random_key
from .joins import broadcast_checked
from .ranking import positions, row_positions
from .selection import percentiles

# --- fixed values: columns that are rounded, model inputs, columns of the summary ---
# Numeric columns that are null-filled, rounded and cast to int before modelling.
ROUND_COLS = ["total_transactions", "total_spent", "avg_spent", "max_spent", "min_spent",
              "days_since_last_transaction", "customer_lifetime", "distinct_transactions",
              "avg_days_between_transactions", "median_basket_size", "basket_size_stddev",
              "total_discount_earned", "discounted_transactions", "total_used_point", "total_earned_point",
              "point_used_transactions"]
# Model inputs (plus the categorical program; the tenant is a key, not an input).
MODEL_FEATURES = ["customer_lifetime", "distinct_transactions", "avg_days_between_transactions", "avg_spent",
                  "max_spent", "min_spent", "median_basket_size", "basket_size_stddev",
                  "discounted_transactions", "total_used_point", "total_earned_point"]
CATEGORICAL = ["program_id"]
SUMMARY_COLS = ["avg_days_between_transactions", "days_since_last_transaction", "customer_lifetime",
                "distinct_transactions", "avg_spent", "max_spent", "total_used_point"]
# --- end of fixed values ---
# Upper bounds on tenants, and on groups of a tenant, whose statistics may be broadcast.
FIRM_ROWS = 100_000
GROUP_ROWS = 1_000_000
# A fit has at most this many tasks per core, or as many as keep a task at this many rows.
FIT_TASKS, FIT_ROWS = 2, 500_000
# Boosting goes on for at most this many rounds, and ends before where so many brought nothing better.
MAX_ROUNDS, PATIENCE = 1000, 50
OUTLIER_KEYS = ["firm_id", "program_id", "is_churn"]
# The fit's groups: without the class, which prediction rows do not have (and which would
# otherwise show in the scale of a column).
FIT_KEYS = ["firm_id", "program_id"]

# --- fixed values: class labels ---
RISK_LOW, RISK_MEDIUM, RISK_HIGH, RISK_UNKNOWN = "low", "medium", "high", "unknown"
LABEL_CHURN, LABEL_NO_RISK = "CHURN", "CHURN RİSKİ YOK"
# --- end of fixed values ---


def _long(df: DataFrame, keys, cols) -> DataFrame:
    w = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return (w.unpivot(list(keys), list(cols), "column", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def outlier_columns(df: DataFrame, keys=OUTLIER_KEYS, cols=ROUND_COLS, ratio: float = 0.01,
                    k: float = 3.0) -> DataFrame:
    """Per group and column: share of values outside [Q1 - k*IQR, Q3 + k*IQR];
    ``flagged`` when the share exceeds ``ratio``.

    The quartiles, a wide row per group, are made first and broadcast to the rows behind
    a size check; values outside are counted in the wide rows, with a map-side partial."""
    keys, cols = list(keys), list(cols)
    q = percentiles(_long(df, keys, cols), keys + ["column"], "value", {"q1": 0.25, "q3": 0.75})
    wide = q.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col(p))).alias(f"_{p}_{c}")
                                  for c in cols for p in ("q1", "q3")])
    j = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).join(
        broadcast_checked(cut_lineage(wide), GROUP_ROWS), keys)
    aggs = []
    for c in cols:
        v, q1, q3 = F.col(c), F.col(f"_q1_{c}"), F.col(f"_q3_{c}")
        held = v.isNotNull() & ~F.isnan(v)
        out = held & ((v < q1 - F.lit(k) * (q3 - q1)) | (v > q3 + F.lit(k) * (q3 - q1)))
        aggs += [F.first(q1).alias(f"_q1_{c}"), F.first(q3).alias(f"_q3_{c}"),
                 F.count_if(held).alias(f"_n_{c}"), F.count_if(out).alias(f"_o_{c}")]
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"_q1_{c}").alias("q1"), F.col(f"_q3_{c}").alias("q3"),
                      F.try_divide(F.col(f"_o_{c}"), F.col(f"_n_{c}")).alias("outlier_ratio"),
                      F.col(f"_n_{c}").alias("n_values")) for c in cols]
    # a column without a value in its group has no row
    out = (j.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*parts)).alias("_s"))
           .select(*keys, "_s.*").where(F.col("n_values") > 0))
    return out.withColumn("flagged", F.col("outlier_ratio") > F.lit(ratio))


def _sqrt(c):
    return F.when(c >= 0, F.sqrt(c))


def suppression_stats(df: DataFrame, flags: DataFrame, keys=OUTLIER_KEYS, cols=ROUND_COLS) -> DataFrame:
    """Mean + 3 * sample std of sqrt(value) for every flagged (group, column), wide per group."""
    keys = list(keys)
    long = _long(df, keys, cols).withColumn("sq", _sqrt(F.col("value")))
    st = long.groupBy(*keys, "column").agg((F.avg("sq") + F.lit(3.0) * F.stddev_samp("sq")).alias("cap"))
    fl = flags.where(F.col("flagged")).select(*keys, "column")
    st = st.join(fl, keys + ["column"])
    return st.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.lit(True))).alias(f"_f_{c}") for c in cols],
        *[F.max(F.when(F.col("column") == c, F.col("cap"))).alias(f"_t_{c}") for c in cols])


def winsorize(df: DataFrame, flags: DataFrame, keys=OUTLIER_KEYS, cols=ROUND_COLS) -> DataFrame:
    """Replace each flagged column by sqrt(value) capped at mean + 3 std (of the sqrt, per group);
    other columns are kept. All listed columns come back as double."""
    return suppress(df, cut_lineage(suppression_stats(df, flags, keys, cols)), keys, cols)


def suppress(df: DataFrame, stats: DataFrame, keys=OUTLIER_KEYS, cols=ROUND_COLS) -> DataFrame:
    """Apply stored suppression statistics (``suppression_stats``, materialized) to any rows; a
    group that has none stays as it is."""
    j = df.join(broadcast_checked(stats, GROUP_ROWS), list(keys), "left")
    repl = {}
    for c in cols:
        v = F.col(c).cast("double")
        sq = _sqrt(v)
        t = F.col(f"_t_{c}")
        capped = F.when(sq > t, t).otherwise(sq)
        repl[c] = F.when(F.col(f"_f_{c}") == F.lit(True), capped).otherwise(v)
    return j.withColumns(repl).drop(*[f"_f_{c}" for c in cols], *[f"_t_{c}" for c in cols])


def round_features(df: DataFrame, cols=ROUND_COLS) -> DataFrame:
    """NULL/NaN -> 0, round half to even, int."""
    return df.withColumns({c: round_int_even(c) for c in cols})


def stratified_split(df: DataFrame, label: str = "is_churn", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``is_val`` flag: per tenant and class, the ceil(test_size * n) rows with the smallest random key.
    Exact class shares; ranks from the distributed position operator (a class can be half
    the data, so no per-class window)."""
    keyed = df.withColumn("_key", random_key(seed + 1))
    r = row_positions(keyed, ["firm_id", label], [F.col("_key"), F.col("unique_customer_id"), F.col("program_id")])
    return (r.withColumn("is_val", F.col("_rank") < F.ceil(F.lit(test_size) * F.col("_n")))
            .drop("_rank", "_n", "_key"))


def class_weights(df: DataFrame, label: str = "is_churn") -> DataFrame:
    """Balanced weights n / (k * n_class) of each tenant, joined as column ``w`` (the count
    frame has one row per tenant and class)."""
    cnt = df.groupBy("firm_id", label).agg(F.count(F.lit(1)).alias("_nc"))
    every = Window.partitionBy("firm_id")
    wt = cnt.select("firm_id", label,
                    (F.sum("_nc").over(every) / (F.count(F.lit(1)).over(every) * F.col("_nc"))).alias("w"))
    return df.join(broadcast_checked(wt, 2 * FIRM_ROWS), ["firm_id", label])


def fit_suppression(train: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Suppression statistics per (firm, program) of the training rows, for training and
    prediction rows alike; a row per group."""
    flags = outlier_columns(train, FIT_KEYS, ratio=params.outlier_ratio, k=params.outlier_k)
    return cut_lineage(suppression_stats(train, flags, FIT_KEYS))


def prepare_training(train: DataFrame, stats: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Outlier suppression by the stored statistics, rounding, split, class weights."""
    t = round_features(suppress(train, stats, FIT_KEYS))
    return class_weights(stratified_split(t, seed=params.seed))


def model_inputs(pred: DataFrame, stats: DataFrame) -> DataFrame:
    """Prediction rows as the model takes them: suppressed by the training statistics and
    rounded. The customers' own (rounded) measures wait in ``_shown``."""
    shown = F.struct(*[round_int_even(c).alias(c) for c in ROUND_COLS])
    return round_features(suppress(pred.withColumn("_shown", shown), stats, FIT_KEYS))


def shown_values(scored: DataFrame) -> DataFrame:
    """The customers' own measures back in place of the model's inputs."""
    return scored.withColumns({c: F.col("_shown")[c] for c in ROUND_COLS}).drop("_shown")


def build_pipeline(params: RunParams = DEFAULT, max_iter: int = 100, max_bins: int = 64) -> Pipeline:
    idx = [StringIndexer(inputCol=f"{c}_s", outputCol=f"{c}_idx", handleInvalid="keep") for c in CATEGORICAL]
    asm = VectorAssembler(inputCols=MODEL_FEATURES + [f"{c}_idx" for c in CATEGORICAL], outputCol="features",
                          handleInvalid="keep")
    gbt = GBTClassifier(labelCol="is_churn", featuresCol="features", weightCol="w", maxIter=max_iter,
                        stepSize=0.05, maxDepth=5, subsamplingRate=0.8, featureSubsetStrategy="0.9",
                        seed=params.seed, maxBins=max_bins)
    return Pipeline(stages=[*idx, asm, gbt])


def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds up to the smallest validation loss before ``patience`` rounds in a row were no better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The boosted model as it was after ``rounds`` rounds."""
    java, sc = model._java_obj, SparkSession.active().sparkContext
    trees, weights = java.trees(), java.treeWeights()
    some = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    shares = sc._gateway.new_array(sc._gateway.jvm.double, rounds)
    for i in range(rounds):
        some[i], shares[i] = trees[i], weights[i]
    cut = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), some, shares, java.numFeatures(), java.numClasses())
    settings = java.extractParamMap().toSeq()
    for i in range(settings.size()):
        cut.set(settings.apply(i))
    return GBTClassificationModel(cut)


def _with_cat_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_s": F.col(c).cast("string") for c in CATEGORICAL})


def fit_partitions(data: DataFrame) -> DataFrame:
    """The (materialized) rows of a fit in no more partitions than its cores and rows need: every round runs some jobs
    over them, and each task of these sends its result to the driver. Equal rows give equal partitions; few stay as they are."""
    most = FIT_TASKS * data.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() <= most:
        return data
    parts = max(most, -(-data.count() // FIT_ROWS))
    if data.rdd.getNumPartitions() <= parts:
        return data
    return cut_lineage(data.repartition(parts, *MODEL_FEATURES).sortWithinPartitions(*data.columns))


def fit_churn(prepared: DataFrame, params: RunParams = DEFAULT, max_iter: int = MAX_ROUNDS,
              patience: int = PATIENCE) -> PipelineModel:
    """Fit on a checkpointed training frame (iterative jobs re-read it, never the lineage).

    At most ``params.churn_max_rows`` rows per tenant enter the fit, a uniform sample; the
    bins follow the number of categories. The loss of the validation rows is taken after
    every round; the model keeps the rounds up to the smallest one. Boosting goes on until
    ``patience`` rounds brought nothing better, so that a noisy round does not end it, or
    for ``max_iter`` rounds: it begins with twice the patience and doubles, the last but one
    time to ``max_iter`` at once (the first rounds of a longer fit are those of the shorter one)."""
    sample = capped_sample(prepared.drop("rnd"), params.churn_max_rows, params.seed)
    data = fit_partitions(cut_lineage(_with_cat_strings(sample).select(
        *MODEL_FEATURES, *CATEGORICAL, *[f"{c}_s" for c in CATEGORICAL], "is_churn", "is_val", "w")))
    most = max(data.agg(*[F.count_distinct(c).alias(c) for c in CATEGORICAL]).first())
    used, held = data.where(~F.col("is_val")), data.where("is_val")
    rounds = min(max_iter, 2 * patience)
    while True:
        model = build_pipeline(params, rounds, max(64, most + 2)).fit(used)
        *before, gbt = model.stages
        losses = gbt.evaluateEachIteration(PipelineModel(before).transform(held)) if not held.isEmpty() else []
        best = best_round(losses, patience) if losses else rounds
        if rounds == max_iter or best + patience <= rounds:
            return PipelineModel([*before, first_rounds(gbt, best)]) if best < rounds else model
        rounds = 2 * rounds if 4 * rounds <= max_iter else max_iter


def churn_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    scored = model.transform(_with_cat_strings(df))
    return scored.withColumn("churn_prob", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction",
        *[f"{c}_s" for c in CATEGORICAL], *[f"{c}_idx" for c in CATEGORICAL])


def risk_class(prob, params: RunParams = DEFAULT):
    p = F.col(prob) if isinstance(prob, str) else prob
    return (F.when(p < params.risk_medium, RISK_LOW)
            .when((p >= params.risk_medium) & (p < params.risk_high), RISK_MEDIUM)
            .when(p >= params.risk_high, RISK_HIGH)
            .otherwise(RISK_UNKNOWN))


def postprocess(scored: DataFrame, params: RunParams = DEFAULT, model_id: int | None = None) -> DataFrame:
    """Class at the scoring threshold, risk class, label text and model id. A row without a score
    has neither class nor label, and the risk class ``unknown``."""
    p = F.col("churn_prob")
    out = scored.withColumns({
        "is_churn_pred": F.when(p >= params.score_threshold, 1).when(p < params.score_threshold, 0),
        "churn_class": risk_class(p, params),
    })
    out = out.withColumn("is_churn_label", F.when(F.col("is_churn_pred") == 1, LABEL_CHURN)
                         .when(F.col("is_churn_pred") == 0, LABEL_NO_RISK))
    return out.withColumn("model_id", F.lit(model_id if model_id is not None else params.run_id).cast("long"))


def stand_in_score(df: DataFrame) -> DataFrame:
    """Deterministic score in [0, 1) for exact checks of the post-model operators."""
    return df.withColumn("churn_prob", (F.col("unique_customer_id") * 7919 % 1000).cast("double") / F.lit(1000.0))


def binary_metrics(df: DataFrame, label: str, prob: str, threshold: float, keys=("firm_id",)) -> DataFrame:
    """Confusion cells, accuracy, precision, recall and F1 per group (one aggregate)."""
    y = F.col(label) == 1
    yhat = F.col(prob) >= F.lit(threshold)
    g = df.groupBy(*keys).agg(
        F.count_if(~y & ~yhat).alias("tn"), F.count_if(~y & yhat).alias("fp"),
        F.count_if(y & ~yhat).alias("fn"), F.count_if(y & yhat).alias("tp"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    return g.withColumns({
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        "precision": prec,
        "recall": rec,
        "f1_score": F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0)),
    })


def auc(df: DataFrame, label: str, prob: str, keys=("firm_id",)) -> DataFrame:
    """ROC-AUC per group by the rank-sum formula with average ranks for ties.

    Scores are pre-aggregated (map-side) to (group, score) -> (positives, negatives);
    ranks come from the distributed position operator. NULL where a group has rows of one
    class only."""
    keys = list(keys)
    s = df.groupBy(*keys, F.col(prob).alias("_s")).agg(
        F.count(F.lit(1)).alias("_c"), F.count_if(F.col(label) == 1).alias("_p"))
    pos = positions(s, keys, ["_s"], "_c")
    avg_rank = F.col("_start") + (F.col("_c") + F.lit(1)).cast("double") / F.lit(2.0)
    g = pos.groupBy(*keys).agg(
        F.sum(F.col("_p") * avg_rank).alias("_rs"),
        F.sum("_p").cast("double").alias("_np"),
        F.sum(F.col("_c") - F.col("_p")).cast("double").alias("_nn"))
    return g.select(*keys, F.try_divide(F.col("_rs") - F.col("_np") * (F.col("_np") + 1) / 2,
                                        F.col("_np") * F.col("_nn")).alias("auc"))


def churn_summary(scored: DataFrame, keys=("firm_id", "is_churn_label", "churn_class", "program_id")) -> DataFrame:
    """Customer count and medians of the customer measures per (firm, label, class, program);
    rows with a NULL key are dropped (pandas group-by)."""
    keys = list(keys)
    s = scored.dropna(subset=keys)
    cnt = s.groupBy(*keys).agg(F.count("unique_customer_id").alias("customer_count"))
    long = _long(s, keys, SUMMARY_COLS)
    med = percentiles(long, keys + ["column"], "value", {"median": 0.5})
    wide = med.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c)
                                    for c in SUMMARY_COLS])
    return cnt.join(wide, keys, "left")


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Per firm: customers and share (1-decimal percent, half-up) by risk class."""
    g = scored.groupBy("firm_id").agg(
        F.count(F.lit(1)).alias("n_customers"),
        *[F.count_if(F.col("churn_class") == c).alias(f"n_{c}") for c in (RISK_LOW, RISK_MEDIUM, RISK_HIGH)])
    return g.withColumns({f"pct_{c}": pct_half_up(F.col(f"n_{c}"), F.col("n_customers"))
                          for c in (RISK_LOW, RISK_MEDIUM, RISK_HIGH)})


def revenue_at_risk(scored: DataFrame) -> DataFrame:
    """Per firm: high-risk customers x their average spend."""
    hi = F.col("churn_class") == RISK_HIGH
    g = scored.groupBy("firm_id").agg(
        F.count_if(hi).alias("n_high"),
        F.avg(F.when(hi, F.col("avg_spent").cast("double"))).alias("avg_spent_high"))
    return g.withColumn("revenue_at_risk", F.round(F.col("n_high") * F.col("avg_spent_high"), 2))


def feature_importances(model: PipelineModel, spark, model_id: int, firm_id=None) -> DataFrame:
    """(feature, importance) of the fitted trees, with the tenant of a per-tenant model; a few rows."""
    gbt = model.stages[-1]
    names = MODEL_FEATURES + CATEGORICAL
    imp = gbt.featureImportances.toArray().tolist()
    rows = [(model_id, n, float(v)) for n, v in zip(names, imp)]
    out = spark.createDataFrame(rows, "model_id long, feature string, importance double")
    return out if firm_id is None else out.withColumn("firm_id", F.lit(firm_id).cast("long"))
