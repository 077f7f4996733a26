"""Left joins of a large fact table to lookup tables.

A lookup is either *measured* and, if small, broadcast, or joined by shuffle with its hot keys
spread over many partitions. Both give exactly the rows of a plain left join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

BROADCAST_BYTES = 64 << 20
HOT_ROWS = 100_000
ROW_ID = "id1"  # tells the rows of a hot key apart; no other column is read for that

_SALT, _SALTS, _ROWS = "_salt", "_salts", "_rows"


def rename_collisions(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple = ("_x", "_y")
) -> tuple[DataFrame, DataFrame]:
    """Give same-named non-key columns the two suffixes, so no name is left twice."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
    )


def _left(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool, salt: Sequence[str] = ()
) -> DataFrame:
    """Left join on ``keys``, where missing ones may match, and on ``salt``, which is never missing."""
    on = [*keys, *salt]
    keep = left.columns + [c for c in right.columns if c not in on]
    if not null_safe:
        return left.join(right, on, "left").select(*keep)
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    same += [F.col(k) == F.col(f"_right_{k}") for k in salt]
    return left.join(right, reduce(and_, same), "left").select(*keep)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows held in memory, by one aggregate over the (small) table."""
    width = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) + 16
        else:
            width = width + 8
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))


def hot_keys(
    counts: DataFrame, rows: int, hot_rows: int = HOT_ROWS, parts: int | None = None
) -> DataFrame | None:
    """Keys holding more than a partition's fair share of ``rows``, and the splits of each.

    Fewer than ``parts`` keys can qualify and their splits add up to at most twice ``parts``, so
    they may be collected and broadcast whatever the data. None if there are none, which needs no
    look at the keys when there are too few rows at all.
    """
    spark = counts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(rows / parts, hot_rows)
    if rows <= share:
        return None
    heavy = counts.where(F.col(_ROWS) > share).collect()
    if not heavy:
        return None
    schema = T.StructType(counts.schema.fields[:-1]).add(_SALTS, T.IntegerType())
    return spark.createDataFrame([(*r[:-1], math.ceil(r[-1] / share)) for r in heavy], schema)


def spread_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
    suffixes: tuple = ("_x", "_y"),
) -> DataFrame:
    """Left join by shuffle in which no key, the missing one included, fills a partition.

    The fact's rows are counted first, and if there are many, those of each key (a scan of the key
    columns). Without hot keys this is a plain join. Else rows of a hot key are split by a hash of
    the row id and its input partition, and the lookup's rows of that key are repeated once per split.
    """
    hot = hot_keys(key_counts(fact, keys), fact.count(), hot_rows)
    return _spread(fact, lookup, list(keys), null_safe, hot, suffixes)


def _spread(
    fact: DataFrame, lookup: DataFrame, keys: list[str], null_safe: bool, hot: DataFrame | None,
    suffixes: tuple = ("_x", "_y"),
) -> DataFrame:
    fact, lookup = rename_collisions(fact, lookup, keys, suffixes)
    if hot is None:
        return _left(fact, lookup, keys, null_safe)
    hot = F.broadcast(hot)
    row = F.col(ROW_ID) if ROW_ID in fact.columns else F.monotonically_increasing_id()
    split = F.pmod(F.xxhash64(F.spark_partition_id(), row), F.col(_SALTS)).cast("int")
    salt = F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(split)
    fact = _left(fact, hot, keys, True).withColumn(_SALT, salt).drop(_SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)
    lookup = _left(lookup, hot, keys, True).withColumn(_SALT, F.explode(copies)).drop(_SALTS)
    return _left(fact, lookup, keys, null_safe, [_SALT]).drop(_SALT)


@dataclass(frozen=True)
class Lookup:
    """A table to attach by ``keys``; ``fill`` replaces the missing values of unmatched rows."""

    table: DataFrame
    keys: Sequence[str]
    fill: Mapping[str, object] = field(default_factory=dict)
    null_safe: bool = False
    dimension: bool = False


def final_names(
    fact: DataFrame, lookups: Sequence[Lookup], suffixes: tuple = ("_x", "_y")
) -> tuple[dict[str, str], list[dict[str, str]]]:
    """What each column is called in the end: of the fact, and of each lookup.

    As if the lookups were merged one after the other, from left to right: a name that both sides
    have gets a suffix on either side. Depends on the schemas only.
    """
    owners: list[dict[str, str]] = [{c: c for c in fact.columns}]
    for lookup in lookups:
        mine = {c: c for c in lookup.table.columns if c not in lookup.keys}
        taken = {now for names in owners for now in names.values()}
        shared = {c for c in mine if c in taken}
        for names in owners:
            names.update({c: now + suffixes[0] for c, now in names.items() if now in shared})
        mine.update({c: c + suffixes[1] for c in shared})
        owners.append(mine)
    every = [now for names in owners for now in names.values()]
    if len(set(every)) < len(every):
        raise ValueError(f"names still collide: {sorted({n for n in every if every.count(n) > 1})}")
    return owners[0], owners[1:]


def attach(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join several lookups while moving the wide fact rows through one shuffle at most.

    Names and fills are settled first, so they never depend on how a lookup is joined. Dimensions
    are broadcast, smallest first, while their sizes add up to ``limit`` at most. The rest is joined
    to the table of distinct fact keys, which is a few columns wide and free of repeats, and that
    table is joined to the fact once.
    """
    own, theirs = final_names(fact, lookups)
    renamed = {own[k] for lookup in lookups for k in lookup.keys if own[k] != k}
    if renamed:
        raise ValueError(f"a lookup brings a column named like a key: {sorted(renamed)}")
    order = [*own.values(), *[n for names in theirs for n in names.values()]]
    fact = fact.withColumnsRenamed(own)
    lookups = [
        replace(one, table=one.table.withColumnsRenamed(names),
                fill={names[c]: v for c, v in one.fill.items() if c in names})
        for one, names in zip(lookups, theirs)
    ]
    plain, large, room = fact, [], limit
    sizes = {i: measured_bytes(one.table) for i, one in enumerate(lookups) if one.dimension}
    for i in sorted(sizes, key=sizes.get):
        if sizes[i] <= room:
            room -= sizes[i]
            one = lookups[i]
            fact = _filled(_left(fact, F.broadcast(one.table), one.keys, one.null_safe), one)
        else:
            large.append(i)
    large = [lookups[i] for i in sorted({*large, *(set(range(len(lookups))) - set(sizes))})]
    if not large:
        return fact.select(*order)
    keys = list(dict.fromkeys(k for one in large for k in one.keys))
    rows, counts = plain.count(), key_counts(plain, keys)
    if _may_be_hot(plain, rows, hot_rows):
        counts = written(counts, "key-counts")  # read for hot keys, their partners and the join
    hot = hot_keys(counts, rows, hot_rows)
    if len(large) == 1:
        (one,) = large
        return _filled(_spread(fact, one.table, keys, one.null_safe, hot), one).select(*order)
    table = counts.drop(_ROWS)
    for one in large:
        # at most one row per distinct key tuple here: hot only where one key has many partners
        partners = None
        if set(one.keys) != set(keys):
            partners = hot_keys(key_counts(counts, one.keys), rows, hot_rows)
        table = _spread(table, one.table, list(one.keys), one.null_safe, partners)
        table = _filled(table, one)
    return _spread(fact, table, keys, True, hot).select(*order)


def _may_be_hot(df: DataFrame, rows: int, hot_rows: int) -> bool:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows > max(rows / parts, hot_rows)


def _filled(df: DataFrame, lookup: Lookup) -> DataFrame:
    return df.fillna(dict(lookup.fill)) if lookup.fill else df
