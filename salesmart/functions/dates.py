"""Calendar attributes and padded ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(day) >= 5


def is_long_weekend(day: Column) -> Column:
    """Friday to Sunday, the days with raised prices."""
    return F.weekday(day) >= 4


def calendar(ts: Column) -> dict[str, Column]:
    """The fact's calendar columns, all derived from one timestamp."""
    day = F.to_date(ts)
    return {
        "transaction_date": day,
        "transaction_time": F.date_format(ts, "HH:mm:ss"),
        "day_of_week": F.date_format(ts, "EEEE"),
        "month": F.date_format(ts, "MMMM"),
        "month_num": F.month(ts),
        "is_weekend": is_weekend(day),
    }


def padded_id(prefix: str, width: int, number: Column) -> Column:
    """``CUST00042``.  Longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", number)


def day_gap(earlier: Column, later: Column) -> Column:
    """Calendar-day boundaries between two timestamps, not spans of 24 hours."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")
