"""Stable pseudo-random numbers from keys: the same after any repartitioning or retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(col: Column) -> Column:
    """The first 32 bits of the MD5 of the key's text, as bigint."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")


def fold_of(col: Column, folds: int) -> Column:
    return (hash_number(col) % folds).cast("int")
