"""Column arithmetic on predicted scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shares of the first and second model in the blend.
BLEND_WEIGHTS = (0.7, 0.3)
# Fixed value: keeps the min-max denominator off zero.
MIN_MAX_EPSILON = 1e-9


def blend(first: Column, second: Column | None = None, weights: tuple = BLEND_WEIGHTS) -> Column:
    """Weighted score; the first model alone where the second gave none."""
    if second is None:
        return first
    return F.coalesce(weights[0] * first + weights[1] * second, first)


def hard_label(score: Column, threshold: float = 0.5) -> Column:
    return (score > threshold).cast("int")


def log_loss(label: Column, score: Column, eps: float = 2.0 ** -52) -> Column:
    """Mean negative log likelihood, as an aggregate; scores are clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(score, F.lit(eps)), F.lit(1.0 - eps))
    return F.avg(F.when(label == 1, -F.ln(p)).otherwise(-F.ln(1.0 - p)))


def min_max(score: Column, low: Column, high: Column) -> Column:
    return (score - low) / (high - low + F.lit(MIN_MAX_EPSILON))
