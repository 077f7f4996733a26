"""Measures of predictions and splits; each returns one small table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores


def log_losses(df: DataFrame, label: str, columns: Mapping[str, str]) -> DataFrame:
    """One row with a log loss per score: ``columns`` maps the result's name to the score's."""
    return df.agg(*[
        scores.log_loss(F.col(label), F.col(score)).alias(name) for name, score in columns.items()
    ])


def prediction_range(df: DataFrame, score: str = "pred") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.min(score).alias("min_pred"), F.max(score).alias("max_pred")
    )


def split_summary(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Rows and target rate of each named part."""
    result = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("target_rate")).select(
            F.lit(name).alias("part"), "n", "target_rate"
        )
        result = row if result is None else result.unionAll(row)
    return result


def match_summary(matched: DataFrame) -> DataFrame:
    """Template rows and how many of them found a prediction."""
    return matched.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col("matched").cast("bigint")), F.lit(0)).alias("n_matched"),
    )


def average_precision(
    df: DataFrame, k: int = 5, key: str = "id2", label: str = "y", score: str = "pred",
    ties: str = "id1",
) -> DataFrame:
    """Average precision of each customer's ``k`` best scores; customers without a click are out.

    Only ``k`` rows per customer and input partition take part in the shuffle, so a customer with
    very many rows costs no more than any other.
    """
    order = Window.partitionBy(key).orderBy(F.desc(score), ties)
    best = (
        df.select(key, label, score, ties)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= k)
        .withColumn("_hits", F.sum(label).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key)
        .agg(F.sum(F.col(label) * F.col("_hits") / F.col("_rank")).alias("_sum"))
    )
    clicks = df.where(F.col(label) > 0).groupBy(key).agg(F.sum(label).alias("_clicks"))
    return clicks.join(best, key).select(
        key, (F.col("_sum") / F.least(F.col("_clicks"), F.lit(k))).alias("ap")
    )


def map_at_k(df: DataFrame, k: int = 5, **columns: str) -> DataFrame:
    return average_precision(df, k, **columns).agg(
        F.count(F.lit(1)).alias("customers"), F.avg("ap").alias(f"map_at_{k}")
    )
