"""Calendar parts and elapsed days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def calendar_parts(col: Column, prefix: str = "time") -> list[Column]:
    """Hour, day, month, weekday (Monday is 0) and weekend flag; a missing date is no weekend."""
    weekday = F.weekday(col)
    return [
        F.hour(col).alias(f"{prefix}_hour"),
        F.dayofmonth(col).alias(f"{prefix}_day"),
        F.month(col).alias(f"{prefix}_month"),
        weekday.alias(f"{prefix}_dayofweek"),
        F.coalesce((weekday >= 5).cast("int"), F.lit(0)).alias(f"{prefix}_is_weekend"),
    ]


def days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, rounded down, also below zero."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(float(MICROS_PER_DAY)))
