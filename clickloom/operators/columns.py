"""Choosing, aligning and filling columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar_parts
from ..functions.values import no_nan


def keep_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that are there, in the given order."""
    return df.select(*[c for c in names if c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str] = (), prefix: str | None = None) -> DataFrame:
    """Without the named columns and those that start with ``prefix``; missing ones are ignored."""
    gone = set(names)
    if prefix:
        gone |= {c for c in df.columns if c.startswith(prefix)}
    return df.select(*[c for c in df.columns if c not in gone])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def align(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), default: float | None = None
) -> DataFrame:
    """``keep`` and then exactly ``features`` in order.

    A feature that is not there becomes ``default``; without a default it is an error.
    """
    missing = [c for c in features if c not in df.columns]
    if missing and default is None:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(
        *keep, *[F.lit(default).alias(c) if c in missing else F.col(c) for c in features]
    )


def fill(df: DataFrame, values: float | Mapping[str, object]) -> DataFrame:
    """Constant for missing values, per column or for every numeric column."""
    return df.fillna(dict(values) if isinstance(values, Mapping) else values)


def with_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Set each column to its constant."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def expand_dates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Calendar parts of each named date in place of the date itself."""
    parts: list[Column] = [p for c in names for p in calendar_parts(F.col(c), c)]
    return df.select(*[c for c in df.columns if c not in names], *parts)


def target_column(df: DataFrame, candidates: Sequence[str] = ("clicked", "y")) -> str:
    """The first candidate that is a column."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"no target column: none of {list(candidates)} found")


def all_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: rows, values, and whether every value is missing / is zero."""
    stats = [F.count(F.lit(1)).alias("rows")]
    for c in names:
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        value = no_nan(F.col(c)) if floating else F.col(c)
        zero = F.coalesce(value.cast("string").try_cast("double") == 0, F.lit(False))
        stats += [F.count(value).alias(f"n_{c}"), F.bool_and(zero).alias(f"z_{c}")]
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{c}").alias("values"),
            (F.col(f"n_{c}") == 0).alias("all_null"),
            F.coalesce(F.col(f"z_{c}"), F.lit(True)).alias("all_zero"),
        )
        for c in names
    ])
    return df.agg(*stats).select("rows", F.inline(entries))
