"""Placement of rows on shards by a permutation-filled lookup table (native functions only).

Every shard has a preference order over the slots of a table of prime size: it starts at an offset
and steps by a skip, both from a hash of its name, so the order is a permutation of all slots. The
shards take turns; in its turn a shard claims the first slot of its order that is still free. All
shards end with the same number of slots, give or take one, and taking a shard out moves few of the
other shards' slots.

The table depends on the list of shards only (``SLOTS`` entries at most, whatever the data), so it
is broadcast, and a row finds its shard by one hash and one look at its slot: no shuffle, and no
key is too hot for it. ``write_shards`` then moves the rows once, to one folder per shard; how many
tasks write a shard follows from its counted rows, so a shard that a hot key has filled is no single task.

Defined results: a missing key is placed by the hash of the empty text; equal keys share a shard;
an empty table gives an empty table, also when written and read back; an existing ``slot`` or
``shard`` column is replaced; repeated rows all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOTS = 6553  # prime, and about a hundred slots per shard
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))
MAX_ROWS = 1_000_000  # rows per file of ``write_shards``


def hash31(text: Column, salt: str) -> Column:
    """31 bits of an MD5, which other engines can compute too."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % F.lit(2**31)


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of every slot: a constant made from the parameters alone, never from data."""
    names = sorted(set(shards))
    if not names:
        raise ValueError("at least one shard is needed")
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime not below the number of shards")

    def number(text: str) -> int:
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 2**31

    def order(name: str):
        first, skip = number("offset:" + name) % slots, number("skip:" + name) % (slots - 1) + 1
        return ((first + c * skip) % slots for c in range(slots))

    orders = [(name, order(name)) for name in names]
    owner: list[str | None] = [None] * slots
    for turn in range(slots):
        name, choices = orders[turn % len(names)]
        owner[next(slot for slot in choices if owner[slot] is None)] = name
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS) -> DataFrame:
    """``(slot, shard)`` for every slot."""
    owners = F.split(F.lit("\n".join(fill(shards, slots))), "\n")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))


def place(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Add ``slot`` (int) and ``shard`` to every row, by the table of ``lookup_table``."""
    slots = table.count()  # a parameter's worth of rows
    at = (hash31(F.coalesce(F.col(key).cast("string"), F.lit("")), "key:") % slots).cast("int")
    rest = [c for c in df.columns if c not in ("slot", "shard")]
    return df.select(*rest, at.alias("slot")).join(F.broadcast(table), "slot").select(
        *rest, "slot", "shard")


def write_shards(placed: DataFrame, path: str, spread: int | None = None, max_rows: int = MAX_ROWS) -> None:
    """Write one folder per shard, in files of ``max_rows`` rows at most.

    A shard has ``spread`` writers, or, where that is not given, as many as its rows ask for at
    ``max_rows`` each: the rows per shard are counted first (the key is all that is read for it), in
    a table of one row per shard. Rows are dealt to the writers by a hash of their place in the input, so
    equal rows part as well. The writer's column stays out of the files.
    """
    sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("__writers"))
    writers = F.ceil(F.col("__writers") / max_rows) if spread is None else F.lit(spread).cast("long")
    row = F.xxhash64(F.monotonically_increasing_id())
    dealt = placed.join(F.broadcast(sizes.withColumn("__writers", writers)), "shard").withColumn(
        "__writer", F.pmod(row, F.col("__writers")))
    (dealt.repartition("shard", "__writer").select(*placed.columns)
     .write.option("maxRecordsPerFile", max_rows).partitionBy("shard").parquet(path))


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that ``write_shards`` wrote; ``schema`` is that of the placed table."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
