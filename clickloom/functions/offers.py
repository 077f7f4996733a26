"""Offer flags and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Discount bucket labels and upper bounds.
UNKNOWN_BUCKET = "unk"
ZERO_BUCKET = "zero"
BUCKET_BOUNDS = ((5.0, "<5"), (20.0, "5-20"), (50.0, "20-50"))
TOP_BUCKET = "50+"


def active_flag(start: Column, end: Column, as_of: Column) -> Column:
    """1 if the day of ``as_of`` lies in the window; an open end never closes it."""
    today = as_of.cast("date").cast("timestamp_ntz")
    return (
        (start.isNull() | (start <= today)) & (end.isNull() | (end >= today))
    ).cast("int")


def discount_bucket(amount: Column) -> Column:
    """Label of a discount (NaN must already be null)."""
    label = F.when(amount.isNull(), UNKNOWN_BUCKET).when(amount == 0, ZERO_BUCKET)
    for bound, name in BUCKET_BOUNDS:
        label = label.when(amount < bound, name)
    return label.otherwise(TOP_BUCKET)
