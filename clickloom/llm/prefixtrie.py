"""Prefix trie of conversations in minimal-perfect-hash tables.

1. ``rebuild`` lays out every conversation's turns, numbered from 1. A turn is a SHA-256 of role and
   text with the text's bytes; texts themselves are never shuffled. Places and prefix digests are
   running totals over a range sort, so a conversation with any number of turns is no single task.
2. A prefix's digest is the exclusive or, over its turns, of two 64-bit hashes of turn and place.
   Distinct digests are the nodes. ``nodes`` verifies that each has one parent digest, one last turn
   and one depth; by induction over the depth equal digests then stand for equal sequences.
3. Nodes go to shards in whole subtrees: each prefix also carries its ancestors' digests at depths 1, 2,
   4, 8, ..., and a node follows its highest ancestor whose subtree has ``limit`` nodes at most. The
   subtrees that are larger number a few per ``BIG`` in all, whatever the data, so their list is small.
4. In a shard, every digest gets a slot by a minimal perfect hash (levels of bit arrays; those without
   rival at a level are placed there), verified against the digest stored in that slot. Ends of
   conversations are scattered into flat arrays, and totals go to the parents' slots, deepest first.
5. Nodes above the cut take part in the next round, with what their subtrees brought as one summed row.
   Every round takes at least the childless nodes; usually two rounds do.
6. ``ends``: ids of the conversations that end at a node are sorted by range, written as pieces of text
   by all tasks, and hashed piece by piece in order, so that no list of ids is ever held.

Defined results: missing role or text is empty; rows without conversation id take no part; turns follow
their number, missing numbers first, equal ones by the SHA-256 of role and text; repeated rows are
turns of their own; an empty table has no nodes. Columns other than the four are ignored. The
remainder of a negative id has its sign (as in SQL).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.running import running
from ..session import written

HEAD = 8  # most turns that a conversation takes from another one
SHARD = 4096  # least limit of a subtree's nodes
BIG = 65_536  # as many limits fit into the whole trie at most
CHUNK = 8192  # ids in a piece of text
HOT = 10_000  # children beyond which a parent's row is broadcast to them
NODE = "p1 long, p2 long, depth int, parent1 long, parent2 long, bytes long"
TOTALS = ("first", "n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = "p1 long, p2 long, parent1 long, parent2 long, depth int, first long, parent_first long, " \
    "n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"
NONE = np.iinfo(np.int64).max  # no conversation


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, sha, bytes)`` per row, without the texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.unhex(F.sha2(both, 256)).alias("sha"),
        F.octet_length(text).cast("long").alias("bytes"))


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its group of five."""
    return (F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)).cast("long")


def rebuild(conversations: DataFrame, made: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv, depth, sha, bytes)`` and all conversations ``(conv,)``."""
    turns = written(turns_of(conversations), "turns", made)
    convs = written(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "n", (F.col("conv") - F.col("conv") % 5).alias("source"), shared_turns(F.col("conv")).alias("h")),
        "conversations", made)
    sources = convs.select(F.col("conv").alias("source"), F.col("n").alias("n_source"))
    # one row ahead of a conversation's turns carries how far they move up, through the same sort
    ahead = convs.join(sources, "source", "left").select(
        "conv", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("binary").alias("sha"), F.lit(0).cast("long").alias("bytes"),
        F.lit(0).alias("one"), (F.least("h", F.coalesce("n_source", F.lit(0))) - F.col("h")).alias("moved"))
    rows = turns.select("*", F.lit(1).alias("one"), F.lit(0).cast("long").alias("moved")).unionByName(ahead)
    placed = running(rows.withColumn("is_turn", F.col("one")), ["conv"], ["is_turn", "turn", "sha"],
                     {"place": F.col("one"), "moved": F.col("moved")}, made=made).where(F.col("is_turn") == 1)
    h = shared_turns(F.col("conv"))
    own = placed.where(F.col("place") > h).select(
        "conv", (F.col("place") + F.col("moved")).cast("int").alias("depth"), "sha", "bytes")
    heads = placed.where((F.col("conv") % 5 == 0) & (F.col("place") <= HEAD)).select(
        F.col("conv").alias("source"), "place", "sha", "bytes")
    taken = convs.join(heads, "source").where(F.col("place") <= F.col("h")).select(
        "conv", F.col("place").cast("int").alias("depth"), "sha", "bytes")
    return own.unionByName(taken), convs.select("conv")


def prefixes(turns: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Each rebuilt turn with the digests of its prefix, its parent and its ancestors at depths 1, 2, 4, ..."""
    deepest = turns.agg(F.max("depth")).first()[0] or 1
    steps = [1 << i for i in range(deepest.bit_length())]
    one, two = F.xxhash64("sha", "depth"), F.xxhash64("depth", F.lit("second"), "sha")
    hashed = turns.select("conv", "depth", "sha", "bytes", one.alias("x1"), two.alias("x2"))
    ancestors = {f"a{s}": F.when(F.col("depth") <= s, F.col("x1")).otherwise(F.lit(0)) for s in steps}
    ran = running(hashed, ["conv"], ["depth"], xors={"p1": F.col("x1"), "p2": F.col("x2"), **ancestors}, made=made)
    there = F.array(*[F.when(F.col("depth") >= s, F.col(f"a{s}")) for s in steps])
    return ran.select(
        "conv", "p1", "p2", "depth", F.col("p1").bitwiseXOR(F.col("x1")).alias("parent1"),
        F.col("p2").bitwiseXOR(F.col("x2")).alias("parent2"), "sha", "bytes", there.alias("up"))


def nodes(rows: DataFrame) -> DataFrame:
    """One row per distinct prefix, verified, without the root."""
    told = F.struct("parent1", "parent2", "depth", "sha")
    grouped = rows.groupBy("p1", "p2").agg(
        F.min(told).alias("least"), F.max(told).alias("most"), F.min("bytes").alias("bytes"), F.min("up").alias("up"))
    sure = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(
        F.raise_error(F.lit("two prefixes share a digest")).cast(grouped.schema["least"].dataType))
    return grouped.withColumn("sure", sure).select(
        "p1", "p2", F.col("sure.depth").alias("depth"), F.col("sure.parent1").alias("parent1"),
        F.col("sure.parent2").alias("parent2"), "bytes", "up")


class Slots:
    """Minimal perfect hash of distinct digests: ``of`` gives each its slot, -1 to unknown ones."""

    def __init__(self, p1: np.ndarray, p2: np.ndarray) -> None:
        self.levels, before = [], 0
        left = np.arange(len(p1))
        while len(left):
            size = 2 * len(left) + 1
            at = self._hash(p1[left], p2[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            taken = np.zeros(size, bool)
            taken[at[alone]] = True
            self.levels.append((taken, before + np.cumsum(taken) - 1))
            before += int(taken.sum())
            left = left[~alone]
            if len(self.levels) > 200:
                raise ValueError("digests are not distinct")
        self.p1, self.p2 = np.empty(len(p1), np.int64), np.empty(len(p1), np.int64)
        slot = self._guess(p1, p2)
        self.p1[slot], self.p2[slot] = p1, p2

    @staticmethod
    def _hash(p1: np.ndarray, p2: np.ndarray, level: int, size: int) -> np.ndarray:
        x = p1.astype(np.uint64) ^ (p2.astype(np.uint64) * np.uint64(2 * level + 0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(32))
        return (x % np.uint64(size)).astype(np.int64)

    def _guess(self, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        slot = np.full(len(p1), -1)
        left = np.arange(len(p1))
        for level, (taken, rank) in enumerate(self.levels):
            at = self._hash(p1[left], p2[left], level, len(taken))
            slot[left[taken[at]]] = rank[at[taken[at]]]
            left = left[~taken[at]]
        return slot

    def of(self, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        slot = self._guess(p1, p2)
        if not len(self.p1):
            return slot
        return np.where((slot >= 0) & (self.p1[slot] == p1) & (self.p2[slot] == p2), slot, -1)


def accumulate(shard: pd.DataFrame) -> pd.DataFrame:
    """Totals of whole subtrees; a node whose parent is elsewhere is a ``top``."""
    column = {c: shard[c].to_numpy() for c in shard.columns}
    table = Slots(column["p1"], column["p2"])
    slot = table.of(column["p1"], column["p2"])

    def flat(name: str) -> np.ndarray:
        out = np.empty(len(slot), column[name].dtype)
        out[slot] = column[name]
        return out

    depth, size = flat("depth"), flat("bytes")
    parent = table.of(flat("parent1"), flat("parent2"))
    first, convs, children, leaves, saved = (flat(name) for name in TOTALS)
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        # all that a level brings is there by now: its own totals are final
        leaves[level] += children[level] == 0
        saved[level] += (convs[level] - 1) * size[level]
        inside = level[parent[level] >= 0]
        to = parent[inside]
        np.minimum.at(first, to, first[inside])
        for totals in (convs, leaves, saved):
            np.add.at(totals, to, totals[inside])
        np.add.at(children, to, 1)
    out = pd.DataFrame({
        "p1": table.p1, "p2": table.p2, "parent1": flat("parent1"), "parent2": flat("parent2"), "depth": depth,
        "first": first, "parent_first": pd.array(np.where(parent >= 0, first[parent], 0), "Int64"),
        "n_convs": convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "top": parent < 0})
    out.loc[parent < 0, "parent_first"] = pd.NA
    return out


def _big(tree: DataFrame, limit: int) -> list[np.ndarray]:
    """For each depth step, the ancestors whose subtrees have more than ``limit`` nodes."""
    steps = tree.select(F.posexplode("up").alias("step", "a")).where(F.col("a").isNotNull())
    large = steps.groupBy("step", "a").count().where(F.col("count") > limit).collect()
    found: dict[int, list[int]] = {}
    for row in large:
        found.setdefault(row["step"], []).append(row["a"])
    return [np.array(sorted(found.get(i, [])), np.int64) for i in range(max(found, default=-1) + 1)]


def _with_shard(tree: DataFrame, big: list[np.ndarray], limit: int, shards: int) -> DataFrame:
    """``shard``: by the highest ancestor with a small subtree; null for nodes above the cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            n = batch.num_rows
            width = len(lists.values) // n if n else 0
            flat = lists.flatten()
            # all lists are equally long: one row of ancestors per node
            known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(n, width)
            up = flat.fill_null(0).to_numpy(zero_copy_only=False).reshape(n, width)
            key, free = np.zeros(n, np.int64), np.ones(n, bool)
            for i in range(width):
                small = known[:, i] & free
                if i < len(big):
                    small &= ~np.isin(up[:, i], big[i])
                key[small] = up[small, i]
                free &= ~small
            shard = ((key.astype(np.uint64) >> np.uint64(11)) % np.uint64(shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard, mask=free)], [*batch.schema.names, "shard"])

    ordered = tree.select(*[c for c in tree.columns if c != "up"], "up")
    schema = T.StructType([*ordered.schema.fields, T.StructField("shard", T.IntegerType())])
    return ordered.mapInArrow(run, schema)


def totals(tree: DataFrame, shard_size: int, made: list[DataFrame]) -> DataFrame:
    """Every node of ``tree`` (its own ends as ``first`` and ``n_convs``) with the totals of its subtree."""
    done = []
    while True:
        n = tree.count()
        limit = max(shard_size, n // BIG)
        if n <= limit:
            last = tree.select(*[c for c in tree.columns if c != "up"], F.lit(0).alias("shard"))
            done.append(written(last.groupBy("shard").applyInPandas(accumulate, RESULT), "totals", made))
            break
        spread = max(-(-n // limit), tree.sparkSession.sparkContext.defaultParallelism)
        with_shard = _with_shard(tree, _big(tree, limit), limit, spread)
        # childless nodes without a shard are subtrees of their own: each round gets on
        lone = with_shard.where(F.col("shard").isNull())
        kids = with_shard.select(F.col("parent1").alias("p1"), F.col("parent2").alias("p2")).distinct()
        parted = written(lone.join(kids.withColumn("has", F.lit(True)), ["p1", "p2"], "left").unionByName(
            with_shard.where(F.col("shard").isNotNull()), allowMissingColumns=True), "parted", made)
        own = F.when(F.col("shard").isNull() & F.col("has").isNull() & (F.col("depth") > 0),
                     F.pmod(F.xxhash64("p1", "p2"), F.lit(spread)).cast("int")).otherwise(F.col("shard"))
        parted = parted.withColumn("shard", own)
        part = written(parted.where(F.col("shard").isNotNull()).drop("has", "up").groupBy("shard").applyInPandas(
            accumulate, RESULT), "totals", made)
        done.append(part)
        brought = part.where("top").groupBy(F.col("parent1").alias("p1"), F.col("parent2").alias("p2")).agg(
            F.min("first").alias("_first"), F.count(F.lit(1)).alias("_n_children"),
            *[F.sum(c).alias(f"_{c}") for c in ("n_convs", "n_leaves", "saved_tokens")])
        above = parted.where(F.col("shard").isNull()).drop("shard", "has").join(brought, ["p1", "p2"], "left")
        new = {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in TOTALS[1:]}
        new["first"] = F.least("first", F.coalesce("_first", F.lit(NONE)))
        tree = written(above.withColumns(new).drop(*[f"_{c}" for c in TOTALS]), "above", made)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def ends_digest(ends: DataFrame, made: list[DataFrame]) -> DataFrame:
    """``(p1, p2, ends_sha256)``: the ids that end at a node, ascending, never held as a list."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            if not len(ids):
                continue
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            starts = np.unique(np.concatenate([[0], cuts, np.arange(0, len(ids), CHUNK)]))
            stops = np.append(starts[1:], len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]),
                 pa.array([",".join(map(str, ids[i:j].tolist())) for i, j in zip(starts, stops)])],
                ["p1", "p2", "at", "text"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (a, b) == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(text.encode())
            yield _named(out)
            out = []
        if key is not None:
            yield _named([(*key, state.hexdigest())])

    def _named(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            ["p1", "p2", "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.select("p1", "p2", "conv").repartitionByRange(parts, "p1", "p2", "conv").sortWithinPartitions(
        "p1", "p2", "conv").mapInArrow(texts, "p1 long, p2 long, at long, text string")
    return pieces.repartition(parts, "p1", "p2").sortWithinPartitions("p1", "p2", "at").mapInArrow(
        hashes, "p1 long, p2 long, ends_sha256 string")


def build(conversations: DataFrame, shard_size: int = SHARD, made: list[DataFrame] | None = None) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    made = [] if made is None else made
    turns, convs = rebuild(conversations, made)
    rows = written(prefixes(written(turns, "rebuilt", made), made), "prefixes", made)
    last = rows.groupBy("conv").agg(F.max_by(F.struct("p1", "p2"), "depth").alias("end"))
    zero = F.lit(0).cast("long")
    ends = written(convs.join(last, "conv", "left").select(
        "conv", F.coalesce("end.p1", zero).alias("p1"), F.coalesce("end.p2", zero).alias("p2")), "ends", made)
    counted = ends.groupBy("p1", "p2").agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("n_convs"))
    width = F.array_repeat(F.lit(None).cast("long"), F.lit(_width(rows)))
    # the root's own parent is no digest of a node: its depth tells
    root = convs.limit(1).select(
        zero.alias("p1"), zero.alias("p2"), F.lit(0).alias("depth"), F.lit(-1).cast("long").alias("parent1"),
        F.lit(-1).cast("long").alias("parent2"), zero.alias("bytes"), width.alias("up"))
    tree = nodes(rows).unionByName(root).join(counted, ["p1", "p2"], "left").withColumns({
        "first": F.coalesce("first", F.lit(NONE)), "n_convs": F.coalesce("n_convs", zero),
        "n_children": zero, "n_leaves": zero, "saved_tokens": zero})
    result = totals(written(tree, "nodes", made), shard_size, made)
    return _described(result, ends_digest(ends, made), made)


def _width(rows: DataFrame) -> int:
    first = rows.select(F.size("up").alias("n")).first()
    return first["n"] if first else 1


def _described(result: DataFrame, digests: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Names of parents for tops of shards, and the digests of ends."""
    inside = result.where(~F.col("top") | (F.col("depth") == 0))
    tops = result.where(F.col("top") & (F.col("depth") > 0)).drop("parent_first")
    parents = result.where(F.col("n_children") > 0).select(
        F.col("p1").alias("parent1"), F.col("p2").alias("parent2"), F.col("first").alias("parent_first"), "n_children")
    # parents with very many children are few: as many as fit into the trie
    total = result.count()
    hot = parents.where(F.col("n_children") > max(HOT, total // BIG)).drop("n_children")
    cool = parents.where(F.col("n_children") <= max(HOT, total // BIG)).drop("n_children")
    keys = ["parent1", "parent2"]
    met = tops.join(F.broadcast(hot.withColumnRenamed("parent_first", "of_hot")), keys, "left")
    named = met.where(F.col("of_hot").isNotNull()).withColumnRenamed("of_hot", "parent_first").unionByName(
        met.where(F.col("of_hot").isNull()).drop("of_hot").join(cool, keys, "left"))
    every = inside.unionByName(named)
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(digests, ["p1", "p2"], "left").select(
        F.col("first").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.col("parent_first").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
