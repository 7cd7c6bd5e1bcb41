"""Reporting windows (from a run date and a report period).

For run date D with m = first day of D's month: the window ends on m - 1 day.
Period 3 starts posting on m - 3 months and creation on m - 4 months + 14 days;
any other period uses m - 13 months and m - 14 months + 14 days. The month
label is the month of the window end.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): month offsets per period and the day shift.
SHORT_PERIOD = 3
SHORT_MONTHS = (3, 4)
LONG_MONTHS = (13, 14)
CREATED_SHIFT_DAYS = 14


def _minus_months(d: dt.date, months: int) -> dt.date:
    """Calendar months back, clamping the day to the target month's length."""
    year, month0 = divmod(d.year * 12 + (d.month - 1) - months, 12)
    day = d.day
    while True:
        try:
            return dt.date(year, month0 + 1, day)
        except ValueError:
            day -= 1


@dataclass(frozen=True)
class ReportWindow:
    run_date: dt.date
    period: int
    from_post: dt.date      # first batch_post_day / open_date / advice create_date
    from_created: dt.date   # first created_date
    to: dt.date             # last day of every window
    month: str              # YYYY-MM of ``to``

    @property
    def month_start(self) -> dt.date:
        return self.to.replace(day=1)


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def report_window(run_date, period: int) -> ReportWindow:
    d = as_date(run_date)
    m = d.replace(day=1)
    post_months, created_months = SHORT_MONTHS if period == SHORT_PERIOD else LONG_MONTHS
    to = m - dt.timedelta(days=1)
    return ReportWindow(
        run_date=d,
        period=period,
        from_post=_minus_months(m, post_months),
        from_created=_minus_months(m, created_months) + dt.timedelta(days=CREATED_SHIFT_DAYS),
        to=to,
        month=to.isoformat()[:7],
    )


def report_window_columns(run_date: Column | str, period: int) -> dict[str, Column]:
    """The same window as Column expressions over a date column."""
    run_date = F.col(run_date) if isinstance(run_date, str) else run_date
    m = F.trunc(run_date.cast("date"), "MM")
    post_months, created_months = SHORT_MONTHS if period == SHORT_PERIOD else LONG_MONTHS
    to = F.date_sub(m, 1)
    return {
        "from_post": F.add_months(m, -post_months),
        "from_created": F.date_add(F.add_months(m, -created_months), CREATED_SHIFT_DAYS),
        "to": to,
        "month": F.date_format(to, "yyyy-MM"),
    }
