"""Mergeable quantile sketches (KLL), for quantiles of very large or arriving input.

A sketch per group is built in one aggregate with a map-side partial; sketches of
parts (batches, months, tenants) merge into that of the whole, so stored sketches
give quantiles without reading the rows again. Quantiles are approximate in rank:
with the default size a quantile's rank is off by less than ``RANK_BOUND`` of the
rows (three times the sketch's 99 % bound); ``rank_errors`` measures it exactly.
The exact operator is ``ranking.percentiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches; bound on the rank error (share of the rows) stated for it.
SIZE, RANK_BOUND = 1600, 0.006


def quantile_sketch(df: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(keys, n, sketch) of ``value``; NULL and NaN are ignored, a group without a value has no row."""
    v = F.col(value).cast("double")
    held = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return held.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One (keys, n, sketch) row per group from the sketches of its parts."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Adds a column per entry of ``probs``: the value whose rank is about that share of ``n``."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in probs.items()})


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, quantiles: DataFrame, probs: dict[str, float]) -> DataFrame:
    """(keys, n, a rank error per entry of ``probs``): how far the quantiles' exact ranks lie from those asked for.

    0 where the share of rows below a quantile and the share up to it enclose its
    probability. ``quantiles`` has a row per group.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = []
    for name in probs:
        counts += [F.count_if(F.col("_v") < F.col(f"_q_{name}")).alias(f"_b_{name}"),
                   F.count_if(F.col("_v") <= F.col(f"_q_{name}")).alias(f"_u_{name}")]
    q = quantiles.select(*keys, *[F.col(name).alias(f"_q_{name}") for name in probs])
    got = rows.join(q, list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts)

    def error(name: str, p: float):
        below, upto = (F.col(f"_{c}_{name}").cast("double") / F.col("n") for c in "bu")
        return F.greatest(F.lit(0.0), below - F.lit(float(p)), F.lit(float(p)) - upto)

    return got.select(*keys, "n", *[error(name, p).alias(name) for name, p in probs.items()])
