"""Scores within a customer, and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import min_max
from .joins import HOT_ROWS, spread_join


def with_rank_score(
    df: DataFrame, key: str = "id2", score: str = "pred", name: str = "rank_score",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Score scaled to 0..1 within ``key``.

    The range per key is a small aggregate joined back, not a window: a window would sort all
    rows of a key in one task, however many it has. A missing key has no range and no score.
    """
    ranges = df.dropna(subset=[key]).groupBy(key).agg(
        F.min(score).alias("_low"), F.max(score).alias("_high")
    )
    joined = spread_join(df, ranges, [key], hot_rows=hot_rows)
    return joined.withColumn(name, min_max(F.col(score), F.col("_low"), F.col("_high"))).drop(
        "_low", "_high"
    )


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]
) -> DataFrame:
    """The values of each key's row with the highest ``order``, which must not repeat in a key.

    An aggregate that shrinks map-side, not a window: repeats of a hot key never meet in one task.
    """
    if len(values) == 1:  # stays a hash aggregate for numbers
        return df.groupBy(*keys).agg(F.max_by(values[0], order).alias(values[0]))
    last = F.max_by(F.struct(*values), order)
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def top(df: DataFrame, by: str, n: int, ties: str) -> DataFrame:
    """The ``n`` rows with the highest ``by``."""
    return df.orderBy(F.desc(by), ties).limit(n)
