"""Exact top-k search by inner product, in blocks with bounds.

Components become whole numbers, floor(256 x). Vectors are range-sorted by the place of their
largest component and packed into blocks of ``BLOCK`` rows; a block keeps its rows as one matrix (its
forward index) and the maximum and minimum of every term. Queries are packed into tiles alike.

A tile meets a span of blocks in one task. For each query, a block's bound is the sum over the
terms of the largest product the block can reach. Blocks are scored in the order of their bounds,
and a query is done once the next bound is below its k-th score. A bound equal to that score is
still scored, as a smaller id may win the tie. The spans' winners are then merged per query.

Whole queries against all rows means that every tile meets every span; each such pair is one task's
work of fixed size, whatever the data.

Defined results: vectors that are missing, or hold a missing or non-finite component, take no part.
Shorter vectors count as filled up with zeros. Repeated rows count once. A query's own id is never
its result; if one id has several vectors, the best score counts. Scores are exact: products that
double precision cannot hold are computed with integers; beyond 62 bits an error is raised.
Columns other than id and vector are ignored; no vectors or no queries give an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

K = 5
SCALE = 256
BLOCK = 256  # rows of a block
SPAN = 32  # blocks that a tile meets in one task
TILE = 1024  # queries of a tile
PACKED = "part int, place long, ids binary, matrix binary, width int"


def whole_numbers(df: DataFrame, id_column: str, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, vector, *keep)`` with usable vectors only, as whole numbers; repeated rows once."""
    v = F.col(vector)
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    numbers = F.transform(v, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    return (df.where(usable & F.col(id_column).isNotNull())
            .select(F.col(id_column).cast("long").alias("id"), numbers.alias("vector"), *keep).distinct())


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of ``rows`` neighbouring vectors, numbered by range and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, ids, held = TaskContext.get().partitionId(), 0, [], []

        def block() -> pa.RecordBatch:
            width = max(map(len, held))
            matrix = np.zeros((len(held), width), np.int64)
            for i, v in enumerate(held):
                matrix[i, :len(v)] = v
            return pa.RecordBatch.from_pylist([{
                "part": part, "place": place, "ids": np.array(ids, np.int64).tobytes(),
                "matrix": matrix.tobytes(), "width": width}], schema=pa.schema([
                    ("part", pa.int32()), ("place", pa.int64()), ("ids", pa.binary()),
                    ("matrix", pa.binary()), ("width", pa.int32())]))

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                held.append(v)
                if len(ids) == rows:
                    yield block()
                    place, ids, held = place + 1, [], []
        if ids:
            yield block()

    lead = F.array_position("vector", F.array_max("vector")).alias("lead")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (vectors.select("id", "vector", lead).repartitionByRange(parts, "lead", "id")
               .sortWithinPartitions("lead", "id").select("id", "vector"))
    return ordered.mapInArrow(run, PACKED)


def _rows(packs: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for ids, matrix, width in zip(packs["ids"], packs["matrix"], packs["width"]):
        ids = np.frombuffer(ids, np.int64)
        out.append((ids, np.frombuffer(matrix, np.int64).reshape(len(ids), width)))
    return out


def _widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def search_span(tiles: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` rows of the span for every query of the tile."""
    queries, span = _rows(tiles), _rows(blocks)
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    if not queries or not span:
        return empty
    width = max(m.shape[1] for _, m in queries + span)
    q_ids = np.concatenate([i for i, _ in queries])
    q = np.concatenate([_widened(m, width) for _, m in queries])
    mats = [_widened(m, width) for _, m in span]
    reach = float(np.abs(q).max(initial=0)) * max(float(np.abs(m).max(initial=0)) for m in mats) * max(width, 1)
    if reach >= 2**62:
        raise OverflowError("scores beyond 62 bits")
    kind = np.float64 if reach < 2**53 else np.int64
    q, mats = q.astype(kind), [m.astype(kind) for m in mats]
    high, low = (np.array([f(m, axis=0) for m in mats]) for f in (np.max, np.min))
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")

    worst = -(2**62)  # can be negated
    scores = np.full((len(q), k), worst, np.int64)
    found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    open_ = np.ones(len(q), bool)
    for step in range(len(mats)):
        block_of = order[:, step]
        open_ &= bounds[np.arange(len(q)), block_of] >= scores[:, -1]
        for b in np.unique(block_of[open_]):
            who = np.flatnonzero(open_ & (block_of == b))
            got = np.rint(q[who] @ mats[b].T).astype(np.int64) if kind is np.float64 else q[who] @ mats[b].T
            ids = np.broadcast_to(span[b][0], got.shape)
            got = np.where(ids == q_ids[who, None], worst, got)
            if got.shape[1] > 4 * k:  # keep what can still be among the best, ties included
                kth = np.partition(got, -k, axis=1)[:, -k]
                most = int((got >= kth[:, None]).sum(axis=1).max())
                pick = np.argsort(-got, axis=1, kind="stable")[:, :most]
                got, ids = np.take_along_axis(got, pick, 1), np.take_along_axis(ids, pick, 1)
            all_s = np.concatenate([scores[who], got], axis=1)
            all_i = np.concatenate([found[who], ids], axis=1)
            best = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            scores[who] = np.take_along_axis(all_s, best, 1)
            found[who] = np.take_along_axis(all_i, best, 1)
    real = scores != worst
    return pd.DataFrame({"query_id": np.repeat(q_ids, k)[real.ravel()],
                         "vec_id": found[real], "score": scores[real]})


def search(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for every row that satisfies ``is_query``."""
    spark = vectors.sparkSession
    blocks = written(packed(whole_numbers(vectors, id_column, vector), BLOCK), "blocks")
    tiles = written(packed(whole_numbers(vectors.where(is_query), id_column, vector), TILE), "tiles")
    n_tiles = max(tiles.count(), 1)
    n_blocks = blocks.count()
    n_spans = max(-(-n_blocks // SPAN), min(n_blocks, spark.sparkContext.defaultParallelism), 1)
    tiles = tiles.withColumn("tile", F.pmod(F.xxhash64("part", "place"), F.lit(n_tiles)).cast("int"))
    # every tile goes to every span: both sides are repeated by the number of the other's pieces
    left = tiles.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(n_spans - 1))))
    right = (blocks.withColumn("span", F.pmod(F.xxhash64("part", "place"), F.lit(n_spans)).cast("int"))
             .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1)))))
    found = left.groupBy("tile", "span").cogroup(right.groupBy("tile", "span")).applyInPandas(
        lambda a, b: search_span(a, b, k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
