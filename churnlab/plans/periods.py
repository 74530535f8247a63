"""Point-in-time configuration of one scoring period.

Every feature builder takes its cutoffs from a ``PeriodConfig`` instead of
hard-coded dates, so the label period, the transaction cutoff and the log
windows can each be set (and reproduced) independently.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def ymd(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


@dataclass(frozen=True)
class PeriodConfig:
    period: str                     # 'YYYY-MM' label month
    prev_period: str | None         # previous label month (lag feature)
    label_start: dt.date            # first day of the label month
    prediction_date: dt.date        # reference for tenure / expiry
    tx_as_of: dt.date | None        # transactions after this are invisible (None = no filter)
    tx_ref: dt.date                 # reference for transaction recency
    log_max_date: dt.date           # log rows after this are dropped
    log_recent: dt.date             # the '30d' window start (inclusive)
    log_windows: dict = field(default_factory=dict)  # name -> window start (inclusive)
    log_ref: dt.date | None = None  # reference for days_since_last (default log_max_date)

    @property
    def log_ref_date(self) -> dt.date:
        return self.log_ref or self.log_max_date


@dataclass(frozen=True)
class LabelWindow:
    hist_start: dt.date
    hist_end: dt.date
    target_start: dt.date
    target_end: dt.date
    grace: int = 30


# fixed values: days back from the cutoff at which the log windows begin
LOG_RECENT_DAYS, LOG_WINDOW_DAYS = 14, {"r7d": 7, "r90d": 90}


def period_config(period: str) -> PeriodConfig:
    """Configuration of a label month: every cutoff is the day before the month begins."""
    start = dt.date(int(period[:4]), int(period[5:]), 1)
    cut = start - dt.timedelta(days=1)
    back = lambda n: cut - dt.timedelta(days=n)
    return PeriodConfig(
        period=period, prev_period=f"{cut:%Y-%m}", label_start=start, prediction_date=cut, tx_as_of=cut, tx_ref=cut,
        log_max_date=cut, log_recent=back(LOG_RECENT_DAYS), log_windows={k: back(n) for k, n in LOG_WINDOW_DAYS.items()})


# Configuration of the driver-table binding (see plans/bindings.py).
DEMO_PERIOD = period_config("2000-12")
DEMO_LABEL_WINDOW = LabelWindow(
    hist_start=dt.date(1998, 1, 1), hist_end=dt.date(1998, 5, 31),
    target_start=dt.date(1998, 6, 1), target_end=dt.date(1998, 6, 30), grace=30,
)
# Label months materialised by the dense label binding.
DEMO_LABEL_PERIODS = ("2000-10", "2000-11", "2000-12")
