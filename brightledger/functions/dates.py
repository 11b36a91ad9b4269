"""Calendar arithmetic with the meaning the analysts' warehouse gives it.

An age counts completed years, and its month part runs 0..11. ``months_between``
is not used: it treats two month ends as a full month apart. All helpers take and
give expression text; a bare name is a column.
"""

from __future__ import annotations

import datetime as dt


def moment(day: dt.date) -> str:
    return f"TIMESTAMP '{day.isoformat()} 00:00:00'"


# Seconds in the 100-day months that ``_position`` counts in.
_MONTH = 100 * 86400


def _position(at: str) -> str:
    """A moment as seconds on a calendar whose months all have 100 days: two moments
    are a whole month apart exactly when their positions are."""
    days = f"((year({at}) * 12L + month({at})) * 100 + day({at}))"
    return f"({days} * 86400 + hour({at}) * 3600 + minute({at}) * 60 + second({at}))"


def completed_months(start: str, end: str) -> str:
    """Whole months between two moments; negative when ``end`` comes first."""
    return f"(({_position(end)} - {_position(start)}) div {_MONTH})"


def age_years(start: str, end: str) -> str:
    return f"CAST({completed_months(start, end)} div 12 AS INT)"


def age_month_part(start: str, end: str) -> str:
    """Months of the age beyond its completed years, -11..11."""
    return f"CAST({completed_months(start, end)} % 12 AS INT)"


def day_of_week(at: str) -> str:
    """0 = Sunday .. 6 = Saturday."""
    return f"(dayofweek({at}) - 1)"


def whole_days(start: str, end: str) -> str:
    """Full 24-hour days from ``start`` to ``end``."""
    return f"timestampdiff(DAY, {start}, {end})"


def clock_hours(start: str, end: str) -> str:
    """Hour part of the span between two ``HH:mm:ss`` texts."""

    def seconds(name: str) -> str:
        hour, minute, second = (f"CAST(split_part({name}, ':', {i}) AS INT)" for i in (1, 2, 3))
        return f"({hour} * 3600 + {minute} * 60 + {second})"

    return f"CAST(({seconds(end)} - {seconds(start)}) div 3600 AS INT)"
