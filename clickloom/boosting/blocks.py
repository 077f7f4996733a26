"""Training rows in blocks: binned features, column by column, as bytes.

Boosting reads its rows some thousand times, so they are laid out for that once. Cut points are
quantiles of about ``SAMPLE`` rows, drawn by a hash of the row, so that they do not change from run to run. A block holds up to ``ROWS`` rows; rows of one list (a
customer, for ranking) lie together, and only lists that do not fit into a block, or lie at the edge of
a range, go on in another block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

ROWS = 16_384
SAMPLE = 200_000  # rows that cut points are taken from
SCHEMA = "block long, n int, bins binary, label binary, held binary, mark binary, list binary, edges binary, scores binary"


def cut_points(rows: DataFrame, vector: str, held: Column, bins: int, n: int) -> list[np.ndarray]:
    """Per feature, the values after which a bin ends; the last bin is open. ``n``: how many rows there are."""
    shares = [i / bins for i in range(1, bins)]
    array = vector_to_array(F.col(vector))
    drawn = rows.where(~held)
    if n > SAMPLE:
        drawn = drawn.where(F.pmod(F.xxhash64(F.lit("cuts"), array), F.lit(2**32)) < int(SAMPLE / n * 2**32))
    each = drawn.select(F.posexplode(array).alias("at", "x")).where(~F.isnan("x"))
    # so fine that ranks are exact
    found = each.groupBy("at").agg(
        F.percentile_approx("x", F.array(*map(F.lit, shares)), 4 * SAMPLE).alias("cuts"), F.max("x").alias("most"))
    width = rows.select(F.size(vector_to_array(vector))).first()
    cuts = [np.empty(0) for _ in range(width[0] if width else 0)]
    for r in found.collect():  # one row per feature
        cuts[r["at"]] = np.array(sorted({c for c in r["cuts"] if c < r["most"]}))
    return cuts


@dataclass
class Block:
    """One block's arrays. ``scores`` has a row per model."""

    bins: np.ndarray  # features x rows
    label: np.ndarray
    held: np.ndarray
    mark: np.ndarray  # a hash of each row, to draw rows by
    list: np.ndarray
    edges: np.ndarray  # lists that may go on in another block
    scores: np.ndarray
    block: int = 0

    @classmethod
    def read(cls, r: dict) -> Block:
        n = r["n"]
        of = lambda c, kind: np.frombuffer(r[c], kind)
        return cls(of("bins", np.uint8).reshape(-1, n), of("label", "<f8"), of("held", np.uint8).astype(bool),
                   of("mark", "<i8"), of("list", "<i8"), of("edges", "<i8"), of("scores", "<f8").reshape(-1, n), r["block"])

    def row(self) -> dict:
        out = {c: np.ascontiguousarray(getattr(self, c)).tobytes() for c in ("bins", "label", "mark", "list", "edges", "scores")}
        return {**out, "held": self.held.astype(np.uint8).tobytes(), "block": self.block, "n": len(self.label)}


ARROW = pa.schema([("block", pa.int64()), ("n", pa.int32()),
                   *[(c, pa.binary()) for c in ("bins", "label", "held", "mark", "list", "edges", "scores")]])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block.read(batch.slice(i, 1).to_pylist()[0])


def lay_out(
    rows: DataFrame, vector: str, label: str, held: Column, cuts: Sequence[np.ndarray],
    base: Sequence[float], lists: Column | None = None, made: list[DataFrame] | None = None, size: int = ROWS,
) -> DataFrame:
    """The blocks of ``rows``; every row starts with the scores ``base``, one per model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, waiting = TaskContext.get().partitionId() << 40, [], 0
        first_of_all, before = None, None

        def block(part: list[np.ndarray], edges: set[int]) -> pa.RecordBatch:
            x, y, h, mark, group = part
            bins = np.empty((len(cuts), len(y)), np.uint8)
            for f, c in enumerate(cuts):
                bins[f] = np.searchsorted(c, x[:, f])
            made = Block(bins, y, h, mark, group, np.array(sorted(edges), "<i8"),
                         np.repeat(np.array(base, "<f8")[:, None], len(y), axis=1), number)
            return pa.RecordBatch.from_pylist([made.row()], schema=ARROW)

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, parts, waiting, first_of_all, before
            if not parts:
                return
            whole = [np.concatenate(c) for c in zip(*parts)]
            group, start, n = whole[4], 0, len(whole[1])
            first_of_all = group[0] if first_of_all is None else first_of_all
            while n - start >= size or (last and start < n):
                stop = min(start + size, n)
                if stop < n:  # end with a list, if one ends in the second half of the block
                    ends = np.flatnonzero(np.diff(group[start:stop + 1])) + 1
                    if len(ends) and ends[-1] > size // 2:
                        stop = start + int(ends[-1])
                edges = {int(g) for g in (first_of_all, before) if g is not None and g in (group[start], group[stop - 1])}
                if stop == n or group[stop] == group[stop - 1]:
                    edges.add(int(group[stop - 1]))
                yield block([c[start:stop] for c in whole], edges)
                before = group[stop - 1] if int(group[stop - 1]) in edges else None
                number, start = number + 1, stop
            parts = [[c[start:] for c in whole]] if start < n else []
            waiting = n - start

        for batch in batches:
            n = batch.num_rows
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)
            rest = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)]
            if n:
                parts.append([x, rest[0].astype("<f8"), rest[1].astype(bool), rest[2], rest[3]])
                waiting += n
            if waiting >= 2 * size:
                yield from cut(False)
        yield from cut(True)

    group = F.lit(0).cast("long") if lists is None else F.xxhash64(lists)
    array = vector_to_array(F.col(vector))
    # equal rows share a mark: which rows a tree draws does not depend on their order
    flat = rows.select(array.alias("x"), F.col(label).cast("double"), held, F.xxhash64(label, array).alias("mark"),
                       group.alias("list"))
    if lists is not None:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        flat = flat.repartitionByRange(parts, "list", "mark").sortWithinPartitions("list", "mark")
    return written(flat.mapInArrow(run, SCHEMA), "blocks", made)
