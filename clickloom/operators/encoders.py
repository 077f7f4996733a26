"""Label encoding: the code of a text is its rank among the distinct texts, from 0."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import filled_text
from ..session import written
from .joins import BROADCAST_BYTES, Lookup, attach

# Above this many other columns they pass the joins as one struct, copied as a block of bytes.
WIDE = 50
_REST = "_rest"
_PART_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


@dataclass
class LabelEncoder:
    """Learns the classes of ``columns``; ``filler`` makes a missing value a class of its own."""

    columns: Sequence[str]
    filler: str | None = None

    def fit(self, *frames: DataFrame) -> "LabelEncoderModel":
        """Distinct values of all columns over all frames in one pass, sorted, numbered.

        The sort is by range, so no task holds a whole domain. Each sorted piece is numbered by
        itself; its place among the pieces then gives the codes.
        """
        pairs = None
        for df in frames:
            cells = F.array(*[
                F.struct(F.lit(c).alias("column"), _class_text(c, self.filler).alias("value"))
                for c in self.columns
            ])
            part = df.select(F.inline(cells))
            pairs = part if pairs is None else pairs.unionAll(part)
        classes = written(
            pairs.where(F.col("value").isNotNull())
            .distinct()
            .orderBy("column", "value")
            .withColumn("slot", F.monotonically_increasing_id()),
            "classes",
        ).withColumn("piece", F.shiftright("slot", _PART_SHIFT))
        # one row per sorted piece: at most partitions + columns of them
        pieces = classes.groupBy("column", "piece").agg(
            F.min("slot").alias("first"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.octet_length("value") + 40).alias("bytes"),
        ).orderBy("column", "piece").collect()
        seen, sizes, shifts = Counter(), Counter(), []
        for p in pieces:
            shifts.append((p["column"], p["piece"], seen[p["column"]] - p["first"]))
            seen[p["column"]] += p["n"]
            sizes[p["column"]] += p["bytes"]
        shift = classes.sparkSession.createDataFrame(
            shifts, "column string, piece bigint, shift bigint"
        )
        table = classes.join(F.broadcast(shift), ["column", "piece"]).select(
            "column", "value", (F.col("slot") + F.col("shift")).alias("code")
        )
        return LabelEncoderModel(table, list(self.columns), self.filler, dict(sizes))


@dataclass
class LabelEncoderModel:
    """``table`` (column, value, code); ``sizes`` the measured bytes of each column's classes."""

    table: DataFrame
    columns: list[str]
    filler: str | None = None
    sizes: dict[str, int] = field(default_factory=dict)

    def transform(
        self,
        df: DataFrame,
        unseen: str = "first",
        null_code: int = -1,
        columns: Sequence[str] | None = None,
        limit: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """Codes in place of the texts.

        Unseen values get the first class (``first``), -1 (``minus_one``) or stop the query
        (``error``). Missing values get ``null_code`` unless a filler made them a class.
        """
        order = df.columns
        names = [c for c in (columns or self.columns) if c in df.columns]
        rest = [c for c in order if c not in names]
        texts = [_class_text(c, self.filler).alias(c) for c in names]
        pack = len(rest) > WIDE
        df = df.select(*([F.struct(*rest).alias(_REST)] if pack else rest), *texts)
        large, room = [], limit
        for c in sorted(names, key=lambda c: self.sizes.get(c, 0)):
            classes = self.table.where(F.col("column") == c).select(
                F.col("value").alias(c), F.col("code").alias(f"_code_{c}")
            )
            if self.sizes.get(c, 0) <= room:  # what is broadcast adds up to the limit at most
                room -= self.sizes.get(c, 0)
                df = df.join(F.broadcast(classes), c, "left")
            else:
                large.append(Lookup(classes, [c]))
        df = attach(df, large)
        out = {
            c: F.when(F.col(c).isNull(), F.lit(null_code)).otherwise(
                F.coalesce(F.col(f"_code_{c}"), _unseen(c, unseen))
            ).cast("bigint").alias(c)
            for c in names
        }
        if pack:
            out |= {c: F.col(_REST).getField(c).alias(c) for c in rest}
        return df.select(*[out.get(c, F.col(c)) for c in order])


def _class_text(name: str, filler: str | None) -> Column:
    return F.col(name).cast("string") if filler is None else filled_text(F.col(name), filler)


def _unseen(name: str, policy: str) -> Column:
    if policy == "first":
        return F.lit(0)
    if policy == "minus_one":
        return F.lit(-1)
    if policy == "error":
        return F.raise_error(F.concat(F.lit(f"unseen value in {name}: "), F.col(name)))
    raise ValueError(f"unknown policy for unseen values: {policy}")
