"""Dates that every report takes, and the values that stand for "none"."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

# The text and dates that stand for "no value" in source rows.
NO_TEXT = " "
NO_DATE = date(1900, 1, 1)
OPEN_DATE = date(2999, 12, 31)
UNKNOWN_CODE = "NA"


def shift_months(day: date, months: int) -> date:
    """`day` moved by whole months; a month end stays a month end."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    at_end = day.day == calendar.monthrange(day.year, day.month)[1]
    return date(year, month + 1, last if at_end else min(day.day, last))


@dataclass(frozen=True)
class Window:
    """Days a report covers, both included."""

    start: date
    end: date

    @classmethod
    def month_to_date(cls, txdate: date) -> Window:
        """The month of the day before a run, up to that day."""
        end = txdate - timedelta(days=1)
        return cls(end.replace(day=1), end)

    @property
    def years(self) -> tuple[int, int]:
        return self.start.year - 1, self.end.year + 1

    @property
    def txdate(self) -> date:
        return self.end + timedelta(days=1)


@dataclass(frozen=True)
class CommissionWindow(Window):
    """Cases of a window, for which commission is paid in `comm_month`."""

    comm_month: date = OPEN_DATE

    @classmethod
    def of_month(cls, comm_month: date) -> CommissionWindow:
        """The case month lies three months before the month of payment."""
        end = shift_months(comm_month, -2) - timedelta(days=1)
        return cls(shift_months(comm_month, -3), end, comm_month)

    @property
    def eve(self) -> date:
        return self.comm_month - timedelta(days=1)
