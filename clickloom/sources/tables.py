"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import NULL_WORDS, blank_words, no_nan, text_to_number
from .schemas import DICTIONARY

# Words a CSV reader takes for true and false.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
    position: str | None = None,
) -> DataFrame:
    """Parquet scan; a declared schema spares the footer reads and fixes the columns.

    NaN counts as missing everywhere in the library, so it becomes null here. ``position`` names a
    column to add that orders the rows as they stand in the files, as in ``read_csv``.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if position:
        df = df.select("*", F.struct(
            "_metadata.file_path", F.lit(0).cast("long").alias("file_block_start"),
            F.col("_metadata.row_index").alias("row")).alias(position))
    return df.withColumns({c: no_nan(F.col(f"`{c}`")) for c in floating}) if floating else df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    null_words: Sequence[str] = NULL_WORDS,
    lenient: bool = False,
    timestamp_format: str | None = None,
    position: str | None = None,
    multi_line: bool = False,
    declared: T.StructType | None = None,
) -> DataFrame:
    """CSV with a header, columns found by name, missing-value words turned to null.

    With a schema, text that does not fit a column's type is an error, or null if ``lenient``.
    Without one the types are learnt from the data by one aggregate, but for columns whose types are
    ``declared``; if all are, nothing is read twice. ``position`` names a column
    to add that orders the rows as they stand in the files, for rules such as "the last one wins".
    ``multi_line`` allows line breaks in quotes; such files cannot be split among tasks.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    raw = reader.csv(paths)
    raw = raw.withColumns({c: blank_words(F.col(f"`{c}`"), null_words) for c in raw.columns})
    if schema is None:
        known = {f.name: f for f in declared.fields} if declared else {}
        learnt = infer_types(raw.drop(*known))
        schema = T.StructType([known.get(c) or learnt[c] for c in raw.columns])
    there = [f for f in schema.fields if f.name in raw.columns]
    typed = [_typed(f, lenient, timestamp_format) for f in there]
    if position:
        typed.append(F.struct(
            "_metadata.file_path", "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("row"),
        ).alias(position))
    return raw.select(*typed)


def _typed(f: T.StructField, lenient: bool, fmt: str | None):
    col, kind = F.col(f"`{f.name}`"), f.dataType
    if isinstance(kind, T.StringType):
        return col
    if lenient and isinstance(kind, T.DoubleType):
        col = text_to_number(col)
    elif fmt and isinstance(kind, T.TimestampNTZType) and not lenient:
        col = F.to_timestamp_ntz(col, F.lit(fmt))
    else:
        col = col.try_cast(kind) if lenient else col.cast(kind)
    return col.alias(f.name)


def infer_types(raw: DataFrame) -> T.StructType:
    """bigint, double or boolean where every value of a text column is one, else string.

    One scan, whatever the number of columns: each value tells which types it fits, and each column
    keeps those that all of its values fit. Only that shrinks to one row per column and task.
    """
    if not raw.columns:
        return T.StructType()
    cells = raw.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in raw.columns])).alias("at", "x"))
    x = F.col("x")
    fits = {
        "whole": x.rlike(r"^\s*[+-]?\d+\s*$") & x.try_cast("bigint").isNotNull(),
        "number": text_to_number(x).isNotNull(),
        "flag": x.isin(*TRUE_WORDS, *FALSE_WORDS),
    }
    seen = {r["at"]: r for r in cells.where(x.isNotNull()).groupBy("at").agg(
        *[F.bool_and(F.coalesce(f, F.lit(False))).alias(name) for name, f in fits.items()]).collect()}
    schema = T.StructType()
    for at, c in enumerate(raw.columns):
        of = seen.get(at)
        if of is None:  # a column without any value
            kind = T.DoubleType()
        else:
            kind = (T.LongType() if of["whole"] else T.DoubleType() if of["number"]
                    else T.BooleanType() if of["flag"] else T.StringType())
        schema = schema.add(c, kind)
    return schema


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """A folder of CSV files, each with a header. Times keep their microseconds."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX").csv(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Column descriptions: masked_column, Description, Type."""
    return spark.read.option("header", True).option("escape", '"').schema(DICTIONARY).csv(path)


def with_comments(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``df`` with the dictionary's description as the comment of each column it names."""
    rows = dictionary.where(F.col("masked_column").isin(df.columns)).collect()  # <= one per column
    comments = {r["masked_column"]: (r["Description"] or "").strip() for r in rows}
    return df.select(*[
        F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
        if f.name in comments else F.col(f"`{f.name}`") for f in df.schema.fields])
