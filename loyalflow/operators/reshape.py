"""Reshaping: melt (wide -> long), pivot (long -> wide, first non-NULL), P-code renames,
and the one-row-per-customer collapse.

The long/wide round trip is kept as an operator, but the P-code tables are
built with a single projection (``to_p_codes``): one pass, no explode, no
shuffle by row id.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import broadcast_checked

# --- fixed values: metric -> P-code dictionary of ANALYTIC_CUSTOMER ---
SEGMENT_P_CODES = {
    "ilk_odeme_tarih": "P1", "son_odeme_tarih": "P2", "recency": "P3", "frequency": "P4", "monetary": "P5",
    "recency_segment": "P6", "monetary_segment": "P7", "frequency_segment": "P8",
    "indirim_duyarli_segment": "P9", "indirim_beklentisi_segment": "P10", "customer_lifespan": "P11",
    "avg_purchase_value": "P12", "clv": "P14", "clv_segment": "P15",
}
CHURN_P_CODES = {
    "avg_days_between_transactions": "P13", "days_since_last_transaction": "P16", "customer_lifetime": "P17",
    "distinct_transactions": "P18", "avg_spent": "P19", "max_spent": "P20", "total_used_point": "P21",
    "churn_prob": "P22", "is_churn": "P23", "churn_class": "P24", "program_id": "P25", "model_id": "P26",
}
# --- end of fixed values ---


def definitions(spark, mapping: dict) -> DataFrame:
    """Metric dictionary as a DataFrame (metric_name, p_code)."""
    return spark.createDataFrame(list(mapping.items()), "metric_name string, p_code string")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "metric_name",
         value: str = "value") -> DataFrame:
    """Wide -> long with values cast to string."""
    w = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in values])
    return w.unpivot(list(ids), list(values), var, value)


def attach_codes(long: DataFrame, defs: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Inner join of long metrics with the metric dictionary (size-checked broadcast)."""
    return long.join(broadcast_checked(defs, max_rows), "metric_name")


def pivot_first(long: DataFrame, ids: Sequence[str], order: str, codes: Sequence[str],
                key: str = "p_code", value: str = "value") -> DataFrame:
    """Long -> wide, one column per code, taking the first non-NULL value in ``order``."""
    nn = long.where(F.col(value).isNotNull())
    return nn.groupBy(*ids).pivot(key, list(codes)).agg(F.min_by(value, order))


def first_non_null(col: str, order: str):
    """First non-NULL value of ``col`` by ``order`` inside a group aggregate."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def to_p_codes(df: DataFrame, ids: Sequence[str], mapping: dict, order: str | None = None) -> DataFrame:
    """Rename metrics to P-codes, values as strings; with ``order`` collapse rows
    per ``ids`` taking the first non-NULL value per code (``pivot_table(aggfunc='first')``)."""
    if order is None:
        return df.select(*ids, *[F.col(m).cast("string").alias(p) for m, p in mapping.items()])
    s = df.select(*ids, order, *[F.col(m).cast("string").alias(p) for m, p in mapping.items()])
    return s.groupBy(*ids).agg(*[first_non_null(p, order).alias(p) for p in mapping.values()])


def collapse_first(df: DataFrame, ids: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """One row per ``ids``: the whole row with the smallest ``order`` (partial aggregation,
    no window over the key)."""
    packed = F.min_by(F.struct(*[F.col(c) for c in [order, *cols]]), F.col(order)).alias("_row")
    return df.groupBy(*ids).agg(packed).select(*ids, *[F.col(f"_row.{c}").alias(c) for c in [order, *cols]])


def rename_by_table(df: DataFrame, defs: DataFrame, keep: Sequence[str],
                    name_col: str = "definition_name", code_col: str = "definition_no",
                    max_entries: int = 10_000) -> DataFrame:
    """Dictionary-driven rename: the definition table is metadata (one row per output
    column), so it is read on the driver - after checking it has at most ``max_entries``
    rows - and turned into one ``select`` with aliases."""
    if defs.limit(max_entries + 1).count() > max_entries:
        raise ValueError(f"definition table has more than {max_entries} entries; not a column dictionary")
    rows = defs.select(name_col, code_col).collect()
    mapping = {r[0].lower(): r[1] for r in rows if r[0] is not None and r[0].lower() in
               {c.lower() for c in df.columns}}
    lower = {c.lower(): c for c in df.columns}
    return df.select(*keep, *[F.col(lower[m]).cast("string").alias(p) for m, p in mapping.items()])
