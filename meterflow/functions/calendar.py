"""Calendar and clock expressions that do not depend on the session time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the wall clock of ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(F.to_date(c)).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the wall clock of ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(F.to_date(c)).cast("long")
    seconds = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")


def epoch_exact(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 00:00 with their fraction, as DOUBLE."""
    return epoch_micros(ts) / F.lit(1e6)


def calendar(ts: str) -> dict[str, Column]:
    """hour, day_of_week (Monday = 0), month, is_weekend."""
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "month": F.month(ts),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def cyclical(hour: str = "hour", day_of_week: str = "day_of_week") -> dict[str, Column]:
    """Hour and weekday as points on a circle."""
    hour_angle = F.col(hour) * F.lit(2 * math.pi / 24)
    day_angle = F.col(day_of_week) * F.lit(2 * math.pi / 7)
    return {
        "hour_sin": F.sin(hour_angle),
        "hour_cos": F.cos(hour_angle),
        "dow_sin": F.sin(day_angle),
        "dow_cos": F.cos(day_angle),
    }
