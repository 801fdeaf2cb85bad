"""Numeric helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero/NULL denominator (never raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def stddev_oracle(x) -> Column:
    """Sample standard deviation, 0 for a single value (Oracle ``STDDEV``)."""
    v = _c(x)
    return F.coalesce(F.stddev_samp(v), F.when(F.count(v) == 1, F.lit(0.0)))


def equal_width_bin(x, lo, hi, bins: int) -> Column:
    """Right-closed equal-width bin number 1..bins over [lo, hi] (``pd.cut``).

    The lowest value lands in bin 1; a constant column (hi == lo) lands in the
    middle bin, as ``pd.cut`` widens a zero range symmetrically.
    """
    xv, lov, hiv = _c(x).cast("double"), _c(lo).cast("double"), _c(hi).cast("double")
    mid = (bins + 1) // 2
    raw = F.ceil(F.try_divide((xv - lov) * F.lit(float(bins)), hiv - lov))
    return (
        F.when(xv.isNull(), F.lit(None).cast("int"))
        .when(hiv == lov, F.lit(mid))
        .otherwise(F.least(F.greatest(F.lit(1), raw.cast("int")), F.lit(bins)))
    )


def pct_half_up(n, total, decimals: int = 1) -> Column:
    """``ROUND(100 * n / total, decimals)`` in exact integer arithmetic, half away
    from zero (SQL ``ROUND`` on exact numbers); NULL when total is 0 or NULL."""
    scale = 10 ** decimals
    nn, tt = _c(n).cast("long"), _c(total).cast("long")
    mag = F.floor(F.try_divide(F.lit(2 * 100 * scale) * F.abs(nn) + tt, F.lit(2) * tt)).cast("long")
    return F.when(tt == 0, F.lit(None).cast("double")).otherwise(
        (F.signum(nn) * mag).cast("double") / F.lit(float(scale)))


def nan_to_null(x) -> Column:
    v = _c(x)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def round_int_even(x) -> Column:
    """NULL/NaN -> 0, round half to even, cast to int (``fillna(0).round(0).astype(int)``)."""
    v = _c(x).cast("double")
    return F.bround(F.coalesce(nan_to_null(v), F.lit(0.0)), 0).cast("int")


def money(x) -> Column:
    """Exact money output: decimal(38,2) for strings; double for statistics."""
    return _c(x).cast("decimal(38,2)")


def money_ratio_2dp(num, den) -> Column:
    """``num / den`` rounded half away from zero to 2 decimals, exactly (integer
    arithmetic on cents), as decimal(38,2). ``num`` is money, ``den`` a count."""
    cents = (_c(num).cast("decimal(38,2)") * F.lit(100)).cast("long")
    n = _c(den).cast("long")
    r = F.signum(cents).cast("long") * F.floor(F.try_divide(F.abs(cents) * F.lit(2) + n, n * F.lit(2))).cast("long")
    r = F.when(cents == 0, F.lit(0).cast("long")).otherwise(r)
    return F.when(n > 0, r.cast("decimal(36,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(38,2)")
