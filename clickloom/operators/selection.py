"""Dropping features that hardly vary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import no_nan
from .numeric_rule import CHUNK


def variances(df: DataFrame, names: Sequence[str], threshold: float = 1e-5) -> DataFrame:
    """One row per column: population variance, and whether it is above ``threshold``.

    NaN counts as missing. Each chunk of columns is an aggregate of its own, which reads its columns
    only.
    """
    result = None
    for i in range(0, len(names), CHUNK):
        part = names[i:i + CHUNK]
        cells = F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("variance")) for c in part
        ])
        rows = df.agg(*[
            F.var_pop(no_nan(F.col(c).cast("double"))).alias(c) for c in part
        ]).select(F.inline(cells))
        result = rows if result is None else result.unionAll(rows)
    return result.withColumn("kept", F.coalesce(F.col("variance") > threshold, F.lit(False)))


@dataclass
class VarianceFilter:
    threshold: float = 1e-5

    def fit(self, df: DataFrame, names: Sequence[str]) -> "VarianceFilterModel":
        stats = variances(df, names, self.threshold).collect()  # one row per column
        kept = {r["feature"] for r in stats if r["kept"]}
        return VarianceFilterModel([c for c in names if c in kept])


@dataclass
class VarianceFilterModel:
    kept: list[str]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*keep, *self.kept)
