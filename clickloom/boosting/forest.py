"""A random forest from histograms that Spark sums up, one pass over the rows for a level of all trees.

Rows are binned once into blocks. In a pass every task sends its rows down each tree, a row with the weight that a
Poisson draw gives it in this tree, and adds up rows and positive labels per (node, drawn feature, bin). The tasks'
histograms meet by node, and the best split by Gini impurity comes to the driver: one row per node. Nothing is kept per
row and tree, so memory grows with neither: a task holds the bytes of its rows and the histograms of a level.

Draws follow from seed, tree and block or level, so a retried task makes the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .blocks import cut_points, lay_out
from .model import BoostedTrees, Tree

ROWS = 65_536  # rows of a block
BINS = 32
POSITIVE = 2.0**26  # rows and positive rows of a task share a number: both are whole and below this
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]),
                          (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)
PARTS = "tree int, node int, sums binary"
SPLITS = "tree int, node int, feature int, bin int, gain double, n double, y double, left_n double, left_y double"


def weights(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often a tree draws each row of a block: Poisson numbers around 1."""
    return POISSON[np.random.default_rng([seed, tree, block]).integers(0, 65_536, n, np.uint16)]


def drawn_features(seed: int, tree: int, level: int, features: int, k: int) -> np.ndarray:
    """The ``k`` features that each node of a level may be split by, in ascending order."""
    chance = np.random.default_rng([seed, tree, level, features]).random((2**level, features))
    return np.sort(np.argsort(chance, axis=1)[:, :k], axis=1)


def _sums(blocks: list, feature: np.ndarray, at_bin: np.ndarray, level: int, tree: int, subset: np.ndarray, seed: int) -> np.ndarray:
    """``(nodes, features, bins)``: rows, and positive ones times ``POSITIVE``, of one tree's level."""
    nodes, k = subset.shape
    total = np.zeros(nodes * k * BINS)
    for number, bins, label in blocks:
        n, flat = bins.shape[1], bins.ravel()
        weight = weights(seed, tree, number, n)
        rows = np.flatnonzero(weight)
        at = np.zeros(len(rows), np.int64)
        for _ in range(level):
            f = feature[at]
            if (f < 0).any():
                live = f >= 0
                rows, at, f = rows[live], at[live], f[live]
            at = 2 * at + 1 + (flat.take(f * n + rows) > at_bin[at])
        # nodes that are leaves already ask for nothing
        live = feature[at] == ASKED
        rows, at = rows[live], at[live] - (nodes - 1)
        worth = weight[rows] * (1 + POSITIVE * label[rows])
        for j in range(k):
            key = (at * k + j) * BINS + flat.take(subset[at, j] * n + rows)
            total += np.bincount(key, worth, len(total))
    return total.reshape(nodes, k, BINS)


ASKED, LEAF = -2, -1  # instead of a feature: a node whose split is not known yet, one without


def best_splits(n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of histograms ``(nodes, features, bins)``: place of the feature, bin, gain, and sums left of the best split."""
    left_n, left_y = n.cumsum(axis=2), y.cumsum(axis=2)
    all_n, all_y = left_n[:, :, -1:], left_y[:, :, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_y**2 / left_n + (all_y - left_y) ** 2 / (all_n - left_n) - all_y**2 / all_n
    gain[(left_n == 0) | (left_n == all_n)] = -np.inf
    flat = gain.reshape(len(n), -1)
    best = flat.argmax(axis=1)
    j, b = np.divmod(best, n.shape[2])
    node = np.arange(len(n))
    # a pure node gains nothing but a rounding error
    pure = (all_y[:, 0, 0] == 0) | (all_y[:, 0, 0] == all_n[:, 0, 0])
    return j, b, np.where(pure, -np.inf, flat[node, best]), left_n[node, j, b], left_y[node, j, b]


def _level(blocks: DataFrame, feature: np.ndarray, at_bin: np.ndarray, level: int, features: int, k: int, seed: int) -> list:
    """The best split of every node of a level that asks for one."""
    nodes = 2**level
    asking = [np.flatnonzero(f[nodes - 1:2 * nodes - 1] == ASKED) for f in feature]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(r["block"], np.frombuffer(r["bins"], np.uint8).reshape(-1, r["n"]), np.frombuffer(r["label"], "<f8"))
                for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()]
        for tree, asked in enumerate(asking if held else []):
            if len(asked):
                found = _sums(held, feature[tree].astype(np.int64), at_bin[tree], level, tree,
                              drawn_features(seed, tree, level, features, k), seed)[asked]
                seen = found.any(axis=(1, 2))
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(seen.sum(), tree, np.int32)), "node": pa.array(asked[seen].astype(np.int32)),
                    "sums": pa.array([x.tobytes() for x in found[seen]], pa.binary())})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, positive = np.empty(0, np.int64), np.empty((0, k, BINS)), np.empty((0, k, BINS))
        for batch in batches:
            if batch.num_rows:
                sums = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, k, BINS)
                more = np.floor(sums / POSITIVE)
                every = np.concatenate([keys, batch.column(0).to_numpy().astype(np.int64) * nodes + batch.column(1).to_numpy()])
                order = np.argsort(every, kind="stable")
                keys, first = np.unique(every[order], return_index=True)
                rows = np.add.reduceat(np.concatenate([rows, sums - more * POSITIVE])[order], first)
                positive = np.add.reduceat(np.concatenate([positive, more])[order], first)
        if len(keys):
            tree, node = np.divmod(keys, nodes)
            j, b, gain, left_n, left_y = best_splits(rows, positive)
            subsets = {t: drawn_features(seed, t, level, features, k) for t in set(tree.tolist())}
            f = np.array([subsets[t][m, i] for t, m, i in zip(tree.tolist(), node.tolist(), j.tolist())])
            columns = [tree.astype(np.int32), node.astype(np.int32), np.where(gain > 0, f, LEAF).astype(np.int32),
                       b.astype(np.int32), gain, rows[:, 0].sum(axis=1), positive[:, 0].sum(axis=1), left_n, left_y]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in SPLITS.split(", ")])

    met = blocks.mapInArrow(add_up, PARTS).repartition("tree", "node").mapInArrow(choose, SPLITS)
    return met.collect()  # one row per node


def _tree(feature: np.ndarray, at_bin: np.ndarray, gain: np.ndarray, n: np.ndarray, y: np.ndarray,
          cuts: Sequence[np.ndarray], trees: int) -> Tree:
    """The nodes that are reached, the root first; a node's value is its share of positive rows, by the number of trees."""
    order, place = [0], {0: 0}
    for i in order:
        if feature[i] >= 0:
            for child in (2 * i + 1, 2 * i + 2):
                place[child] = len(order)
                order.append(child)
    at = np.array(order)
    inner = feature[at] >= 0
    child = lambda side: np.array([place[2 * i + side] if s else -1 for i, s in zip(order, inner)])
    threshold = np.array([cuts[feature[i]][at_bin[i]] if s else 0.0 for i, s in zip(order, inner)])
    return Tree(np.where(inner, feature[at], -1), np.where(inner, at_bin[at], -1), threshold, child(1), child(2),
                y[at] / n[at] / trees, np.where(inner, gain[at], 0.0), n[at].astype(np.int64))


def fit_forest(rows: DataFrame, name: str, vector: str, label: str, held: Column, trees: int = 100, depth: int = 10,
               seed: int = 42) -> BoostedTrees:
    """A forest of ``trees`` trees of up to ``depth`` levels on 0/1 labels; its score is the trees' mean share.

    Each node may use about the square root of the number of features, drawn for it; a single tree uses all.
    """
    target = F.col(label)
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~target.isin(0.0, 1.0) | target.isNull(), 1)).alias("bad")).first()
    if not told["n"] or told["bad"]:
        raise ValueError(f"a forest needs rows whose labels are all 0 or 1: {told['bad']} of {told['n']} are not")
    made: list[DataFrame] = []
    cuts = cut_points(rows, vector, held, BINS, told["n"])
    blocks = lay_out(rows, vector, label, held, cuts, [], made=made, size=ROWS).select("block", "n", "bins", "label")
    features = len(cuts)
    k = features if trees == 1 else math.ceil(math.sqrt(features))
    size = 2 ** (depth + 1) - 1
    feature, at_bin = np.full((trees, size), LEAF, np.int16), np.zeros((trees, size), np.uint8)
    gain, n, y = (np.zeros((trees, size)) for _ in range(3))
    feature[:, 0] = ASKED
    for level in range(depth):
        found = _level(blocks, feature, at_bin, level, features, k, seed)
        feature[feature == ASKED] = LEAF
        for t, node, f, b, g, rows_in, good, left_n, left_y in found:
            i = node + 2**level - 1
            n[t, i], y[t, i] = rows_in, good
            if f != LEAF:
                feature[t, i], at_bin[t, i], gain[t, i] = f, b, g
                for child, cn, cy in ((2 * i + 1, left_n, left_y), (2 * i + 2, rows_in - left_n, good - left_y)):
                    n[t, child], y[t, child] = cn, cy
                    if level + 1 < depth and 0 < cy < cn:
                        feature[t, child] = ASKED
        if not (feature == ASKED).any():
            break
    discard(*made)
    # a tree that drew no row at all says nothing
    drawn = np.flatnonzero(n[:, 0])
    return BoostedTrees(name, 0.0, [_tree(feature[t], at_bin[t], gain[t], n[t], y[t], cuts, len(drawn)) for t in drawn],
                        False, vector)
