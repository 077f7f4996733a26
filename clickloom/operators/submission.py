"""Predictions in the layout of a submission, and on the rows of a template."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import filled_text, key_long, parse_timestamp
from ..session import written
from .columns import all_zero
from .joins import HOT_ROWS, spread_join
from .ranking import last_per_key
from .running import running

# Parts of a rebuilt row id and the date of a row without one.
ID_SLOT = "16-23_2023-11-05"
DEFAULT_DATE = "11/05/2023"
ZERO_IDS = ("0.0", "0")
DATE_FORMAT = "MM/dd/yyyy"


def composite_id(slot: str = ID_SLOT) -> Column:
    return F.concat_ws("_", filled_text(F.col("id2"), "0"), filled_text(F.col("id3"), "0"), F.lit(slot))


def usable(df: DataFrame, names: tuple = ("id1", "id5")) -> set[str]:
    """Those of the columns that are there and not zero throughout; one aggregate."""
    there = [c for c in names if c in df.columns]
    if not there:
        return set()
    return {r["column"] for r in all_zero(df, there).collect() if not r["all_zero"]}


def format_submission(
    df: DataFrame,
    keep: set[str] | None = None,
    slot: str = ID_SLOT,
    default_date: str = DEFAULT_DATE,
    date_formats: tuple = (),
    score: str = "pred",
) -> DataFrame:
    """id1, id2, id3, id5 (as MM/dd/yyyy text) and pred.

    ``keep`` names which of id1 and id5 to take from the rows; the others are rebuilt. By default
    that is decided by ``usable``.
    """
    keep = usable(df) if keep is None else keep
    row_id = composite_id(slot)
    if "id1" in keep:
        own = F.col("id1").cast("string")
        row_id = F.when(own.isNull() | own.isin(*ZERO_IDS), row_id).otherwise(own)
    day = F.lit(default_date)
    if "id5" in keep:
        is_text = dict(df.dtypes)["id5"] == "string"
        when = parse_timestamp(F.col("id5"), date_formats) if is_text else F.col("id5")
        day = F.coalesce(F.date_format(when, DATE_FORMAT), day)
    return df.select(
        row_id.alias("id1"),
        key_long(F.col("id2"), 0).alias("id2"),
        key_long(F.col("id3"), 0).alias("id3"),
        day.alias("id5"),
        F.col(score).alias("pred"),
    )


def match_template(
    template: DataFrame, predictions: DataFrame, order: str, default: float = 0.0,
    hot_rows: int = HOT_ROWS, keys: Sequence[str] = ("id2", "id3"),
) -> DataFrame:
    """Every template row with the last prediction of its ``keys``, else ``default``.

    A prediction that is missing for a key that is there stays missing and counts as matched.
    """
    keys = list(keys)
    as_long = {k: F.col(k).cast("string" if k == "id1" else "bigint") for k in keys}
    last = last_per_key(predictions.withColumns(as_long), keys, order, ["pred"]).select(
        *keys, F.col("pred").cast("double").alias("pred"), F.lit(True).alias("matched")
    )
    rows = template.drop("pred", "matched").withColumns(as_long)
    found = F.coalesce("matched", F.lit(False))
    return (
        spread_join(rows, last, keys, hot_rows=hot_rows)
        .withColumn("pred", F.when(found, F.col("pred")).otherwise(F.lit(default)))
        .withColumn("matched", found)
    )


def row_numbers(df: DataFrame, position: str, name: str) -> DataFrame:
    """Each row's number (from 0) in its table's files, taken in the order of their names.

    ``position`` is the column that ``read_csv`` and ``read_parquet`` add: file, start of the block, row. Rows of a
    block are read one after the other, so a block needs only its first row and the rows of the
    blocks before it: one row per block, and no sort of the table.
    """
    made = written(df, "numbered")  # read twice, and the rows' marks must be the same
    block = [F.col(f"{position}.{f}").alias(f"_{f}") for f in ("file_path", "file_block_start")]
    row = F.col(f"{position}.row")
    blocks = made.groupBy(*block).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n"))
    upto = running(blocks, [], ["_file_path", "_file_block_start"], {"_upto": F.col("_n")}).select(
        "_file_path", "_file_block_start", "_first", (F.col("_upto") - F.col("_n")).alias("_before"))
    keyed = made.select("*", *block)
    return keyed.join(upto, ["_file_path", "_file_block_start"]).select(
        *[c for c in df.columns if c != name], (F.col("_before") + row - F.col("_first")).alias(name))


def match_by_position(
    template: DataFrame, predictions: DataFrame, position: str = "_position", default: float = 0.0
) -> DataFrame:
    """Every template row with the prediction that stands at the same place of its files, else ``default``.

    For templates without row ids, in which a customer and offer may come several times.
    """
    rows = row_numbers(template.drop("pred", "matched"), position, "_number")
    scores = row_numbers(predictions.select("pred", position), position, "_number").select(
        "_number", F.col("pred").cast("double").alias("pred"), F.lit(True).alias("matched"))
    met = rows.join(scores, "_number", "left")
    found = F.coalesce("matched", F.lit(False))
    return met.withColumn("pred", F.when(found, F.col("pred")).otherwise(F.lit(default))).withColumn(
        "matched", found).drop("_number", position)
