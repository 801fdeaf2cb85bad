"""Date helpers as built-in Column expressions (JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def frac_days(end, start) -> Column:
    """``end - start`` in fractional days (Oracle DATE arithmetic)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(MICROS_PER_DAY)


def avg_frac_days(end, start) -> Column:
    """Aggregate: mean of ``end - start`` in days. The microseconds are summed as whole numbers,
    so that the result does not hang on the order in which partials meet."""
    gap = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.try_divide(F.sum(gap).cast("double"), F.count(gap).cast("double") * F.lit(MICROS_PER_DAY))


def day_diff(end, start) -> Column:
    """Whole-day difference of truncated dates (``TRUNC(a) - TRUNC(b)``)."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def parse_date_key(key) -> Column:
    """``yyyyMMdd`` integer/string key -> DATE; zero-filled to 8 digits, invalid -> NULL."""
    return F.try_to_date(F.lpad(_c(key).cast("string"), 8, "0"), "yyyyMMdd")


def to_date_key(d) -> Column:
    """DATE/TIMESTAMP -> ``yyyyMMdd`` string."""
    return F.date_format(_c(d), "yyyyMMdd")


def iso_weekday(d) -> Column:
    """Monday=1 .. Sunday=7 (Julian-day ``MOD(J,7)+1``)."""
    return F.weekday(_c(d)) + F.lit(1)


def is_weekend(d) -> Column:
    return iso_weekday(d).isin(6, 7)


def completed_years(as_of: Column, birth) -> Column:
    """``FLOOR(MONTHS_BETWEEN(as_of, birth) / 12)`` (age in completed years)."""
    return F.floor(F.months_between(as_of, _c(birth)) / F.lit(12)).cast("int")


def age_band(age) -> Column:
    a = _c(age)
    return (
        F.when((a >= 18) & (a <= 25), "18-25")
        .when((a >= 26) & (a <= 35), "26-35")
        .when((a >= 36) & (a <= 45), "36-45")
        .when((a >= 46) & (a <= 55), "46-55")
        .when(a >= 56, "56+")
    )


def birthday_this_year(birth, as_of_year: Column) -> Column:
    """Birthday moved into the as-of year, 29 Feb folded to 28 Feb."""
    b = _c(birth)
    m, d = F.month(b), F.dayofmonth(b)
    return F.make_date(as_of_year, m, F.when((m == 2) & (d == 29), F.lit(28)).otherwise(d))
