"""Calendar expressions; Monday is day 0."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PEAK_HOURS = [7, 8, 9, 15, 16, 17, 18]


def cyclical(value: Column, period: int, offset: int = 0) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * (value - offset) / period
    return F.sin(angle), F.cos(angle)


def weekend(ts: str) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def years_between(ts: str, first: int, last: int) -> Column:
    """Inclusive year range as a range on the timestamp itself, so the scan can use it."""
    start = F.lit(f"{first:04d}-01-01 00:00:00").cast("timestamp_ntz")
    stop = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= start) & (F.col(ts) < stop)


def on_date(ts: str, day: str) -> Column:
    start = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY"))


def day_type(flag: str = "is_weekend") -> Column:
    return F.when(F.col(flag) == 0, "Weekday").when(F.col(flag) == 1, "Weekend")


def time_band(hour: str = "hour") -> Column:
    h = F.col(hour)
    return (
        F.when((h >= 0) & (h < 6), "Night")
        .when((h >= 6) & (h < 12), "Morning")
        .when((h >= 12) & (h < 18), "Afternoon")
        .when((h >= 18) & (h < 24), "Evening")
    )
