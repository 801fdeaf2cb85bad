"""Fitted scalers: statistics per tenant, taken once and applied to any rows.

``fit_scaler`` returns one row per tenant with a shift and a width for each column;
stored, it scales rows that were not there when it was fitted. A scaled value is
``(x - shift) / width``; a constant column (width 0) scales to 0. NULL and NaN are
left out of the statistics and stay NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_checked
from .selection import percentiles

KINDS = ("minmax", "standard", "robust")
#: Tenants whose statistics may be broadcast.
FIRM_ROWS = 100_000


def _value(c: str):
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "minmax", keys: Sequence[str] = ("firm_id",)) -> DataFrame:
    """(keys, shift and width per column): minimum and range (``minmax``), mean and population
    standard deviation (``standard``), or median and interquartile range (``robust``)."""
    keys, cols = list(keys), list(cols)
    if kind == "robust":
        long = df.select(*keys, *[_value(c).alias(c) for c in cols]).unpivot(keys, cols, "column", "value")
        q = percentiles(long, [*keys, "column"], "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75})

        def of(c: str, e):
            return F.max(F.when(F.col("column") == c, e))

        return q.groupBy(*keys).agg(*[x for c in cols for x in (
            of(c, F.col("q2")).alias(f"_shift_{c}"), of(c, F.col("q3") - F.col("q1")).alias(f"_width_{c}"))])
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}: one of {', '.join(KINDS)}")
    aggs = []
    for c in cols:
        v = _value(c)
        pair = (F.min(v), F.max(v) - F.min(v)) if kind == "minmax" else (F.avg(v), F.stddev_pop(v))
        aggs += [pair[0].alias(f"_shift_{c}"), pair[1].alias(f"_width_{c}")]
    return df.groupBy(*keys).agg(*aggs)


def scale(df: DataFrame, fitted: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("firm_id",)) -> DataFrame:
    """Adds ``<column>_scaled`` by the stored statistics; NULL for a tenant that has none."""
    j = df.join(broadcast_checked(fitted, FIRM_ROWS), list(keys), "left")
    scaled = {}
    for c in cols:
        off, width = _value(c) - F.col(f"_shift_{c}"), F.col(f"_width_{c}")
        scaled[f"{c}_scaled"] = F.when(width == 0, off * 0.0).otherwise(F.try_divide(off, width))
    return j.withColumns(scaled).drop(*[f"_{w}_{c}" for c in cols for w in ("shift", "width")])
