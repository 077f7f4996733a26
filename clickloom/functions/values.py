"""Typed, null-safe values from raw columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words a CSV reader takes for "no value".
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def no_nan(col: Column) -> Column:
    """NaN means missing."""
    return F.when(~F.isnan(col), col)


# Decimal notation, or infinity. A cast alone would also take 1d, 0x1p3 and nan.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def text_to_number(col: Column) -> Column:
    """Number in a text, or null."""
    return F.when(col.rlike(_NUMBER), col).try_cast("double")


def number(df: DataFrame, name: str, default: float | None = None) -> Column:
    """Column ``name`` as double, null (or ``default``) where it holds no number."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        col = text_to_number(F.col(name))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        col = no_nan(F.col(name).cast("double"))
    else:
        col = F.col(name).cast("double")
    return col if default is None else F.coalesce(col, F.lit(float(default)))


def blank_words(col: Column, words: Sequence[str] = NULL_WORDS) -> Column:
    """Null for any of ``words``."""
    return F.when(~col.isin(list(words)), col)


def key_text(col: Column) -> Column:
    """Join key as string; a missing key stays missing."""
    return col.cast("string")


def key_long(col: Column, default: int | None = None) -> Column:
    """Join key as bigint. Without ``default`` bad text is an error, with it the default."""
    if default is None:
        return col.cast("bigint")
    return F.coalesce(col.try_cast("bigint"), F.lit(default).cast("bigint"))


def parse_timestamp(col: Column, formats: Iterable[str] = ()) -> Column:
    """Wall-clock time in a text, null where no format fits.

    Without formats the ISO forms are read. Formatted text is parsed as UTC and rebuilt from its
    microseconds, so hours a time zone skips stay as written, whatever the session zone is.
    """
    formats = list(formats)
    if not formats:
        return col.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    parsed = []
    for fmt in formats:
        instant = F.try_to_timestamp(F.concat(col, F.lit(" +00:00")), F.lit(f"{fmt} XXX"))
        parsed.append(F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch))
    return F.coalesce(*parsed)


# Formats tried where a caller names none. ISO forms come first and need no format.
DATE_FORMATS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy HH:mm:ss",
                "dd/MM/yyyy HH:mm:ss", "yyyyMMdd", "dd-MMM-yyyy")


def date_format_shares(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """One row per candidate format (empty text for ISO): values of the column, and how many parse."""
    forms = ["", *formats]
    parsed = [parse_timestamp(F.col(name), [f] if f else []) for f in forms]
    cells = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(f).alias("format"), F.col("values"), F.col(f"p{i}").alias("parsed"))
        for i, f in enumerate(forms)
    ])
    counts = [F.count(p).alias(f"p{i}") for i, p in enumerate(parsed)]
    return df.agg(F.count(name).alias("values"), *counts).select(F.inline(cells))


def infer_date_format(
    df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS
) -> list[str]:
    """The format most values of a text column parse with, as the argument of ``parse_timestamp``.

    One aggregate; ties go to the format listed first. An error if there are values and none parse.
    """
    rows = date_format_shares(df, name, formats).orderBy(F.desc("parsed"), "place").collect()
    best = rows[0]  # one row per format
    if best["values"] and not best["parsed"]:
        raise ValueError(f"no date in column {name}: none of its values fits ISO or {list(formats)}")
    return [best["format"]] if best["format"] else []


def strict_timestamp(col: Column, fmt: str | None = None) -> Column:
    """Wall-clock time in a text; text that does not parse is an error."""
    return F.to_timestamp_ntz(col, F.lit(fmt)) if fmt else col.cast("timestamp_ntz")


def wall_clock(moment: date) -> Column:
    """A date or time as a literal that no time zone moves."""
    if isinstance(moment, datetime):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(moment.isoformat()).cast("date")


def filled_text(col: Column, filler: str) -> Column:
    """Text with ``filler`` for a missing value."""
    return F.coalesce(col.cast("string"), F.lit(filler))
