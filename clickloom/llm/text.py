"""Column expressions and batches of texts that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters outside these (blank, tab to carriage return).
NOT_WORD = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, NOT_WORD), lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, few at a time: a task's Python objects stay small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
