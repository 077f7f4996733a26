"""Running totals inside groups, without a task that holds a group.

The rows are range-sorted by group and order, so a large group runs through several sorted pieces.
Each piece adds up its own rows; the totals at its end (one row per piece, as many as shuffle
partitions whatever the data) tell what the group brings into the next piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

PART, LAST = "_part", "_last"


def _changes(batch: pa.RecordBatch, keys: Sequence[int], before: pa.RecordBatch | None) -> np.ndarray:
    """True where a row's group differs from that of the row before it; missing keys are equal."""
    new = np.zeros(batch.num_rows, bool)
    for k in keys:
        column = batch.column(k)
        if before is None:
            new[0] = True
        else:
            column = pa.concat_arrays([before.column(k).slice(before.num_rows - 1), column])
        here, there = column.slice(1), column.slice(0, len(column) - 1)
        unlike = pc.or_(pc.fill_null(pc.not_equal(here, there), False), pc.xor(pc.is_null(here), pc.is_null(there)))
        new[batch.num_rows - len(here):] |= unlike.to_numpy(zero_copy_only=False)
    return new


def _accumulate(op: np.ufunc, values: np.ndarray, new: np.ndarray, carried: int) -> np.ndarray:
    """``op`` over the rows of each group so far; ``op`` is addition or exclusive or."""
    total = op.accumulate(values)
    starts = np.flatnonzero(new)
    undo = np.subtract if op is np.add else op
    at = np.cumsum(new)  # 0: the group of the row before this batch
    base = np.concatenate([[carried if op is not np.add else -carried], np.where(starts > 0, total[starts - 1], 0)])
    return undo(total, base.astype(np.int64)[at])


def _pass(ordered: Iterator[pa.RecordBatch], n_keys: int, sums: int, xors: int) -> Iterator[pa.RecordBatch]:
    """Totals per piece. The input ends in the keys, then the values; ``LAST`` marks the last row."""
    part, before, held = TaskContext.get().partitionId(), None, None
    carried = [0] * (sums + xors)
    for batch in ordered:
        if not batch.num_rows:
            continue
        if held is not None:
            yield held(False)
        width = batch.num_columns
        first = width - sums - xors
        keys = range(first - n_keys, first)
        new = _changes(batch, keys, before)
        totals = []
        for i in range(sums + xors):
            values = pc.fill_null(batch.column(first + i), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            totals.append(_accumulate(np.add if i < sums else np.bitwise_xor, values, new, carried[i]))
        carried = [int(t[-1]) for t in totals]
        before = batch

        def held(ends: bool, batch=batch, totals=totals, first=first) -> pa.RecordBatch:
            last = np.zeros(batch.num_rows, bool)
            last[-1] = ends
            columns = [batch.column(i) for i in range(first)] + [pa.array(t) for t in totals] + [
                pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(last)]
            return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])
    if held is not None:
        yield held(True)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    xors: Mapping[str, Column] | None = None,
    made: list[DataFrame] | None = None,
) -> DataFrame:
    """``df`` with running totals of whole numbers, the row's own included.

    Totals run over the rows with equal ``keys`` (missing ones are equal to each other) in ascending
    ``order``, missing values first; make the order total if rows must not tie. A missing number
    counts as 0. ``sums`` add up, modulo 2^64; ``xors`` take the exclusive or.
    """
    spark = df.sparkSession
    sums, xors = dict(sums or {}), dict(xors or {})
    values = {**sums, **xors}
    rest = [c for c in df.columns if c not in values]
    spare = [f"_key{i}" for i in range(len(keys))]
    wide = df.select(
        *rest, *[F.col(k).alias(s) for k, s in zip(keys, spare)],
        *[v.cast("long").alias(name) for name, v in values.items()])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = wide.repartitionByRange(parts, *spare, *order).sortWithinPartitions(*spare, *order)
    fields = [wide.schema[c] for c in [*rest, *spare]] + [T.StructField(n, T.LongType()) for n in values]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                          + [T.StructField(PART, T.IntegerType()), T.StructField(LAST, T.BooleanType())])
    n_keys, n_sums, n_xors = len(spare), len(sums), len(xors)
    # written: the pieces of a range sort may fall differently when they are computed again
    pieces = written(ordered.mapInArrow(
        lambda batches: _pass(batches, n_keys, n_sums, n_xors), schema), "running", made)
    ends = pieces.where(LAST).select(PART, *spare, *values).collect()  # one row per piece
    brought, carried = [], None
    for row in sorted(ends, key=lambda r: r[PART]):
        key, totals = tuple(row[s] for s in spare), [row[n] for n in values]
        if carried is not None:
            brought.append((row[PART], *carried[0], *carried[1]))
            if carried[0] == key:
                totals = [_both(i < n_sums, a, b) for i, (a, b) in enumerate(zip(totals, carried[1]))]
        carried = (key, totals)
    into = T.StructType([schema[PART], *[schema[s] for s in spare], *[schema[n] for n in values]])
    offsets = spark.createDataFrame(brought, into).select(
        F.col(PART).alias("_p"), *[F.col(s).alias(f"{s}_") for s in spare],
        *[F.col(n).alias(f"_in{i}") for i, n in enumerate(values)])
    same = F.col(PART) == F.col("_p")
    for s in spare:
        same = same & F.col(s).eqNullSafe(F.col(f"{s}_"))
    added = []
    for i, n in enumerate(values):
        more = F.coalesce(F.col(f"_in{i}"), F.lit(0).cast("long"))
        added.append((F.col(n) + more if i < n_sums else F.col(n).bitwiseXOR(more)).alias(n))
    return pieces.join(F.broadcast(offsets), same, "left").select(*rest, *added)


def _both(add: bool, a: int, b: int) -> int:
    """The total of both, as a 64-bit number."""
    if not add:
        return a ^ b
    return (a + b + 2**63) % 2**64 - 2**63
