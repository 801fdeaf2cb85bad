"""Run parameters: the "as of" time and every threshold, resolved once on the driver.

Nothing in the library reads the wall clock; every time-relative rule derives
its cut-off from ``RunParams.as_of`` so results are reproducible.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months(ts: datetime, months: int) -> datetime:
    """Calendar month shift that keeps the time of day and sticks to month end
    (a last-day-of-month input maps to the last day of the target month)."""
    y, m0 = divmod(ts.month - 1 + months, 12)
    y += ts.year
    m = m0 + 1
    src_last = calendar.monthrange(ts.year, ts.month)[1]
    dst_last = calendar.monthrange(y, m)[1]
    d = dst_last if ts.day == src_last else min(ts.day, dst_last)
    return ts.replace(year=y, month=m, day=d)


def ts_lit(ts: datetime) -> Column:
    """Zone-free timestamp literal (TIMESTAMP_NTZ), constant-folded by Catalyst."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def date_lit(d: date) -> Column:
    return F.lit(d.strftime("%Y-%m-%d")).cast("date")


def date_key(ts: datetime) -> int:
    """Integer ``yyyyMMdd`` key of a timestamp."""
    return ts.year * 10000 + ts.month * 100 + ts.day


@dataclass(frozen=True)
class RunParams:
    """Everything a run depends on besides the input tables."""

    as_of: datetime = datetime(2001, 8, 1, 12, 0, 0)
    # churn: label window and eligibility
    churn_threshold: int = 180
    churn_min_transactions: int = 3
    churn_min_spend: float = 100.0
    churn_max_rows: int = 500_000
    seed: int = 42
    # RFM / customer base minimum spend (HAVING SUM > min_spend)
    min_spend: float = 15.0
    # purchase profile window
    profile_months: int = 24
    # recency segment thresholds (days)
    active_days: int = 90
    risk_days: int = 180
    new_days: int = 30
    # scoring thresholds
    validation_threshold: float = 0.5
    score_threshold: float = 0.6
    risk_medium: float = 0.6
    risk_high: float = 0.95
    # outlier handling
    outlier_ratio: float = 0.01
    outlier_k: float = 3.0
    # audit
    created_by: str = "ANALYTICS_ADMIN"
    run_id: int = 1
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)

    # --- derived literals -------------------------------------------------
    @property
    def as_of_date(self) -> date:
        return self.as_of.date()

    @property
    def churn_cutoff(self) -> datetime:
        return self.as_of - timedelta(days=self.churn_threshold)

    def months_back(self, n: int) -> datetime:
        return add_months(self.as_of, -n)

    @property
    def profile_key(self) -> int:
        """``yyyyMMdd`` lower bound of the rolling profile window."""
        return date_key(self.months_back(self.profile_months))

    @property
    def as_of_col(self) -> Column:
        return ts_lit(self.as_of)

    @property
    def as_of_date_col(self) -> Column:
        return date_lit(self.as_of_date)

    @property
    def audit_ts_col(self) -> Column:
        """Run day as a zone-free timestamp at midnight (CREATE_DATE / UPDATE_DATE)."""
        return ts_lit(datetime(self.as_of.year, self.as_of.month, self.as_of.day))


DEFAULT = RunParams()
