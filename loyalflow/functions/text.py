"""Text helpers for the firm narrative, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these must equal the reference's narrative vocabulary ---
# Turkish month names, January .. December.
MONTHS_TR = [
    "Ocak", "Şubat", "Mart", "Nisan", "Mayıs", "Haziran",
    "Temmuz", "Ağustos", "Eylül", "Ekim", "Kasım", "Aralık",
]
# Possessive suffix by the last digit of the printed number (digits 1..9).
# The reference prints "'9" for 9, a typo; the grammatical form "'u" is used.
SUFFIX_BY_DIGIT = {1: "'i", 2: "'si", 3: "'ü", 4: "'ü", 5: "'i", 6: "'sı", 7: "'si", 8: "'i", 9: "'u"}
# Suffix for round tens 10..90 (last digit 0).
SUFFIX_BY_TENS = {10: "'u", 20: "'si", 30: "'u", 40: "'ı", 50: "'si", 60: "'ı", 70: "'i", 80: "'i", 90: "'ı"}
# Fallback for other numbers ending in 0 (100, 0, ...).
SUFFIX_OTHER = "ü"
# --- end of fixed values ---


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_name_tr(m) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in MONTHS_TR]), _c(m).cast("int"))


def num_text(x, decimals: int = 1) -> Column:
    """Print a number with at most ``decimals`` decimals, trailing ``.0`` trimmed."""
    v = F.round(_c(x).cast("double"), decimals)
    whole = v.cast("long").cast("string")
    frac = F.regexp_replace(F.format_number(v, decimals), ",", "")
    return F.when(v == F.floor(v), whole).otherwise(frac)


def thousands(x) -> Column:
    """Integer with thousands separators (``f"{n:,}"``)."""
    return F.format_number(_c(x).cast("long"), 0)


def tr_suffix(printed: Column) -> Column:
    """Suffix chosen from the last character of the printed number."""
    last = F.substring(printed, -1, 1)
    digit_map = F.create_map(*[x for k, v in SUFFIX_BY_DIGIT.items() for x in (F.lit(str(k)), F.lit(v))])
    tens_map = F.create_map(*[x for k, v in SUFFIX_BY_TENS.items() for x in (F.lit(str(k)), F.lit(v))])
    return (
        F.when(last != "0", F.element_at(digit_map, last))
        .otherwise(F.coalesce(F.element_at(tens_map, printed), F.lit(SUFFIX_OTHER)))
    )
