"""Fit and apply the rule that makes every feature column numeric."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import number, text_to_number
from .columns import date_columns, expand_dates, numeric_columns, text_columns
from .encoders import LabelEncoder, LabelEncoderModel

CHUNK = 100  # columns per aggregate, to stay inside generated code


def number_shares(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per text column: rows, values, values that are numbers, and the share of them."""
    result = None
    for i in range(0, len(names), CHUNK):
        part = names[i:i + CHUNK]
        stats = [F.count(F.lit(1)).alias("rows")]
        for c in part:
            stats += [F.count(c).alias(f"v_{c}"), F.count(text_to_number(F.col(c))).alias(f"n_{c}")]
        cells = F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                F.col("rows").alias("rows"),
                F.col(f"v_{c}").alias("values"),
                F.col(f"n_{c}").alias("numbers"),
                F.try_divide(F.col(f"n_{c}"), F.col("rows")).alias("share"),
            )
            for c in part
        ])
        rows = df.agg(*stats).select(F.inline(cells))
        result = rows if result is None else result.unionAll(rows)
    return result.withColumn("is_numeric", F.coalesce(F.col("share") > 0.5, F.lit(False)))


@dataclass
class NumericRule:
    """Text columns that are mostly numbers become numbers, the others are label encoded.

    Before that, the columns named in ``dates`` and all columns of a date or timestamp type are
    replaced by their calendar parts, and booleans by 0 and 1.
    """

    dates: Sequence[str] = ()

    def fit(self, df: DataFrame) -> "NumericRuleModel":
        dates = [c for c in df.columns if c in self.dates or c in date_columns(df)]
        df = expand_dates(df, dates)
        names = text_columns(df)
        # one row per text column, however large the table
        stats = number_shares(df, names).collect() if names else []
        numeric = [r["column"] for r in stats if r["is_numeric"]]
        empty = [r["column"] for r in stats if r["values"] == 0]
        encoded = [c for c in names if c not in numeric and c not in empty]
        encoder = LabelEncoder(encoded).fit(df) if encoded else None
        return NumericRuleModel(dates, numeric, encoded, empty, encoder)


@dataclass
class NumericRuleModel:
    dates: list[str]
    numeric: list[str]
    encoded: list[str]
    empty: list[str]
    encoder: LabelEncoderModel | None = field(default=None)

    def transform(self, df: DataFrame, unseen: str = "first", skip: Sequence[str] = ()) -> DataFrame:
        """Numbers only: missing codes are -1, any other missing value 0; ``skip`` stays as is."""
        df = expand_dates(df, [c for c in self.dates if c in df.columns])
        flags = [f.name for f in df.schema.fields
                 if isinstance(f.dataType, T.BooleanType) and f.name not in skip]
        df = df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df
        change = {c: number(df, c) for c in self.numeric if c in df.columns}
        change |= {c: F.lit(-1).cast("bigint") for c in self.empty if c in df.columns}
        df = df.withColumns(change) if change else df
        if self.encoder:
            df = self.encoder.transform(df, unseen=unseen)
        return df.fillna(0, subset=[c for c in numeric_columns(df) if c not in skip])
