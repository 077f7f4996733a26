"""Training / validation splits and folds."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import fold_of, hash_number
from ..functions.values import wall_clock
from ..session import written
from .joins import HOT_ROWS, spread_join
from .running import running

HALF = 1 << 16  # buckets of one look at 32-bit hashes
LARGE = 10  # a group is large from this part of a fold on


def time_split(df: DataFrame, column: str, at: date | datetime) -> tuple[DataFrame, DataFrame]:
    """Rows before ``at`` and rows from ``at`` on; a missing date is in neither."""
    moment = wall_clock(at)
    return df.where(F.col(column) < moment), df.where(F.col(column) >= moment)


def in_sample(key: Column, share: float, seed: int = 42) -> Column:
    """True for about ``share`` of the keys, by hash: the choice survives repartitioning."""
    salted = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return hash_number(salted) < F.lit(int(share * (1 << 32))).cast("bigint")


def random_split(
    df: DataFrame, key: str = "id1", test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    test = in_sample(F.col(key), test_share, seed)
    return df.where(~test), df.where(test)


def with_group_fold(
    df: DataFrame, key: str = "id2", folds: int = 5, name: str = "fold"
) -> DataFrame:
    """Number the folds so that all rows of one ``key`` share a fold."""
    return df.withColumn(name, fold_of(F.col(key), folds))


def _boundary(df: DataFrame, number: Column, rank: int) -> tuple[int, int]:
    """The ``rank``-th smallest (from 1) of a 32-bit number's values, and its rank among equal ones.

    Two counts per bucket, of the high and of the low half, instead of a sort.
    """
    high = F.shiftright(number, 16)
    found = []
    for half, rows in ((high, df), (number.bitwiseAND(HALF - 1), None)):
        rows = df.where(high == found[0]) if rows is None else rows
        counts = rows.groupBy(half.alias("half")).count().collect()  # ``HALF`` rows at most
        for row in sorted(counts, key=lambda r: r["half"]):
            if row["count"] >= rank:
                found.append(row["half"])
                break
            rank -= row["count"]
    return found[0] * HALF + found[1], rank


def exact_split(
    df: DataFrame, key: str = "id1", test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Like ``random_split``, but exactly the share of the rows, rounded up, goes out.

    Those with the smallest hashes of the key go; among equal ones the whole row's hash decides. Rows that
    are equal in every column and lie on the boundary stay in together.
    """
    whole = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(1 << 32))
    # a missing key has a hash too: its rows take part
    salted = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    hashed = df.withColumns({"_hash": hash_number(salted), "_whole": whole})
    n = hashed.count()
    out = math.ceil(Fraction(str(test_share)) * n)
    if not 0 < out < n:
        return (df, df.limit(0)) if out <= 0 else (df.limit(0), df)
    at, rank = _boundary(hashed, F.col("_hash"), out)
    ties = hashed.where(F.col("_hash") == at)
    below = F.col("_hash") < at
    if rank == ties.count():
        test = below | (F.col("_hash") == at)
    else:
        edge, left = _boundary(ties, F.col("_whole"), rank)
        test = below | ((F.col("_hash") == at) & (F.col("_whole") < edge))
        if left == ties.where(F.col("_whole") == edge).count():
            test = test | ((F.col("_hash") == at) & (F.col("_whole") == edge))
    return hashed.where(~test).select(*df.columns), hashed.where(test).select(*df.columns)


def fold_bounds(loads: Sequence[int], rest: int) -> list[int]:
    """Where a fold ends when ``rest`` rows, one after the other, fill folds that hold ``loads`` already:
    all folds are filled up to the same level, and a fuller one takes nothing."""
    level, order = Fraction(0), sorted(loads)
    for i in range(1, len(order) + 1):
        level = Fraction(sum(order[:i]) + rest, i)
        if i == len(order) or level <= order[i]:
            break
    ends, total = [], Fraction(0)
    for load in loads:
        total += max(level - load, 0)
        ends.append(math.ceil(total))
    return ends


def with_balanced_fold(
    df: DataFrame, key: str = "id2", folds: int = 5, name: str = "fold", large: int = LARGE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Folds of about equal size, with all rows of one ``key`` in the same; a missing key has no fold.

    Large groups (a ``large``-th of a fold or more; as many as ``folds`` times ``large`` at most) are placed one by
    one, the largest first, each in the emptiest fold. The others, sorted by size, fill the folds up to
    a common level by a running sum: a fold is off by one such group at most, and no order of all groups is
    held anywhere.
    """
    made: list[DataFrame] = []
    sizes = written(df.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "groups", made)
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    is_large = F.col("_n") * folds * large >= total
    loads, placed = [0] * folds, []
    for row in sizes.where(is_large).orderBy(F.desc("_n"), key).collect():
        fold = loads.index(min(loads))
        loads[fold] += row["_n"]
        placed.append((row[key], fold))
    small = sizes.where(~is_large).select(key, "_n", (-F.col("_n")).alias("_order"))
    upto = running(small, [], ["_order", key], {"_upto": F.col("_n")}, made=made)
    bounds = fold_bounds(loads, total - sum(loads))
    number = sum(((F.col("_upto") - F.col("_n") >= b).cast("int") for b in bounds[:-1]), F.lit(0))
    of_small = upto.select(key, number.alias(name))
    fields = T.StructType([sizes.schema[key], T.StructField(name, T.IntegerType())])
    of_large = df.sparkSession.createDataFrame(placed, fields)
    return spread_join(df.drop(name), of_small.unionByName(of_large), [key], hot_rows=hot_rows)


def numbered_by_date(df: DataFrame, column: str = "id5", ties: str = "id1", name: str = "position") -> DataFrame:
    """Each row's place (from 1) in the order of ``column``, missing dates first, then of ``ties``."""
    return running(df, [], [column, ties], {name: F.lit(1)})


def sorted_by_date(df: DataFrame, column: str = "id5") -> DataFrame:
    """Date order for output; the splits need none."""
    return df.orderBy(column)
