"""Declared layouts of the input tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Feature columns that hold a category, or a 0/1 flag. f218 does not exist.
CATEGORY_FEATURES = ("f42", "f48", "f50", "f52", "f53", "f54", "f55", "f56", "f57", "f349", "f354")
FLAG_FEATURES = tuple(f"f{i}" for i in range(226, 310))
NO_FEATURE = "f218"
FEATURE_COUNT = 366


def feature_field(name: str) -> T.StructField:
    if name in CATEGORY_FEATURES:
        return T.StructField(name, T.StringType())
    if name in FLAG_FEATURES:
        return T.StructField(name, T.IntegerType())
    return T.StructField(name, T.DoubleType())


def impressions(label: str | None = "y", features: int = FEATURE_COUNT) -> T.StructType:
    """Training rows, or test rows with ``label=None``."""
    schema = (
        T.StructType()
        .add("id1", T.StringType())
        .add("id2", T.LongType())
        .add("id3", T.LongType())
        .add("id4", T.TimestampNTZType())
        .add("id5", T.DateType())
    )
    if label:
        schema = schema.add(label, T.IntegerType())
    for i in range(1, features + 1):
        if f"f{i}" != NO_FEATURE:
            schema = schema.add(feature_field(f"f{i}"))
    return schema


EVENTS = T.StructType().add("id2", T.LongType()).add("id3", T.LongType())

TRANSACTIONS = (
    T.StructType()
    .add("id2", T.LongType())
    .add("f367", T.StringType())
    .add("f370", T.TimestampNTZType())
)

OFFERS = (
    T.StructType()
    .add("id3", T.LongType())
    .add("id9", T.StringType())
    .add("id10", T.StringType())
    .add("id11", T.StringType())
    .add("id12", T.TimestampNTZType())
    .add("id13", T.TimestampNTZType())
    .add("f374", T.TimestampNTZType())
    .add("f375", T.StringType())
    .add("f376", T.DoubleType())
)

DICTIONARY = (
    T.StructType()
    .add("masked_column", T.StringType())
    .add("Description", T.StringType())
    .add("Type", T.StringType())
)

TEMPLATE = T.StructType().add("id2", T.LongType()).add("id3", T.LongType())
