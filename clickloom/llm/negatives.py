"""Hard negatives from score windows, by an STR-packed R-tree.

Vectors become whole numbers, floor(256 x). ``plant`` packs all rows by sort-tile-recurse: rows are
range-sorted by label and by the coordinate that varies most, each run of ``TREE`` rows is one slab, and a
slab is tiled by the next coordinates into leaves of ``LEAF`` rows. Leaves and, ``FAN`` by ``FAN``, the nodes above
them keep their minimum bounding box and range of labels: a slab is one R-tree, stored as one row.

A query vector and a box give an interval of inner products: per coordinate the least and the greatest
product, summed. ``best_first`` keeps the nodes of a tree in a queue, greatest upper end first, and drops a box
whose interval lies outside every window, is strictly below the k-th score found in every window it
meets (an equal score can still win by its id), or whose labels cannot fit.

Mining runs this twice: an anchor's positives are the best of its own label; each positive's score gives
a window for rows of other labels. Before any rows are shipped, anchors meet the trees' bounding boxes
alone, and a group of anchors is sent only the trees that some anchor of it still needs. Work is cut into
groups of ``TILE`` anchors and ``SPAN`` trees, whatever the data, and merged by rank.

Defined results: rows without id, label or vector, or with a missing or non-finite component, take no part.
Repeated rows count once; rows that share an id but not label or vector are rows of their own, and an anchor
never meets its own id. Shorter vectors count as filled up with zeros. Positives with an empty window
give no rows; no anchors or an empty table give an empty table. Other columns are ignored. Scores are exact;
beyond 62 bits an error is raised.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .topk import whole_numbers

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
TREE = 4096  # rows of a tree
LEAF = 64
FAN = 8
TILED = 2  # coordinates that tile a slab
TILE = 1024  # anchors of a group
SPAN = 16  # trees that a group meets in one task
BOXES = 1024  # trees whose boxes a group meets in one task
LIMIT = 2**62
FAR = np.iinfo(np.int64).max


def usable_rows(vectors: DataFrame, label: Column, id_column: str, vector: str) -> DataFrame:
    """``(id, label, vector)``, each different row once."""
    labelled = vectors.select(F.col(id_column).alias("_id"), F.col(vector).alias("_vector"), label.cast("long").alias("_label"))
    return whole_numbers(labelled, "_id", "_vector", keep=["_label"]).withColumnRenamed("_label", "label").where(
        F.col("label").isNotNull())


def spread_of(rows: DataFrame) -> list[int]:
    """Coordinates, the one with the greatest variance first."""
    each = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.var_pop("x").alias("v"))
    return [r["at"] for r in each.orderBy(F.desc("v"), "at").collect()]


def _tiled(matrix: np.ndarray, axes: list[int]) -> np.ndarray:
    """An order of the rows in which runs of ``LEAF`` are tiles: sorted by the first axis, cut into
    slabs, each sorted by the next axis."""
    order = np.arange(len(matrix))

    def sort(part: np.ndarray, axes: list[int]) -> np.ndarray:
        if not axes or len(part) <= LEAF:
            return part
        part = part[np.argsort(matrix[part, axes[0]], kind="stable")]
        leaves = -(-len(part) // LEAF)
        slabs = max(round(leaves ** (1 / len(axes))), 1)
        size = -(-leaves // slabs) * LEAF
        return np.concatenate([sort(part[i:i + size], axes[1:]) for i in range(0, len(part), size)])

    return sort(order, [a for a in axes if a < matrix.shape[1]])


def _boxes(matrix: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
    """Box and label range of every node: leaves first, then each level above, the root last."""
    at = np.arange(0, len(matrix), LEAF)
    low, high = (f.reduceat(matrix, at) for f in (np.minimum, np.maximum))
    least, most = (f.reduceat(labels, at) for f in (np.minimum, np.maximum))
    levels = [(low, high, least, most)]
    while len(levels[-1][0]) > 1:
        below = levels[-1]
        at = np.arange(0, len(below[0]), FAN)
        levels.append(tuple(f.reduceat(x, at) for f, x in zip((np.minimum, np.maximum) * 2, below)))
    return tuple(np.concatenate(x) for x in zip(*levels))


FOREST = "tree long, n int, width int, ids binary, labels binary, matrix binary, low binary, high binary, " \
    "least binary, most binary"


def plant(rows: DataFrame) -> DataFrame:
    """One row per tree: its rows in leaf order and the boxes of its nodes."""
    axes = spread_of(rows)
    lead, rest = (axes or [0])[0], axes[1:1 + TILED]
    fields = pa.schema([("tree", pa.int64()), ("n", pa.int32()), ("width", pa.int32()),
                        *[(c, pa.binary()) for c in ("ids", "labels", "matrix", "low", "high", "least", "most")]])

    def tree(number: int, ids: list, labels: list, held: list) -> pa.RecordBatch:
        width = max(map(len, held))
        matrix = np.zeros((len(held), width), np.int64)
        for i, v in enumerate(held):
            matrix[i, :len(v)] = v
        order = _tiled(matrix, rest)
        ids, labels, matrix = np.array(ids, np.int64)[order], np.array(labels, np.int64)[order], matrix[order]
        parts = [ids, labels, matrix, *_boxes(matrix, labels)]
        return pa.RecordBatch.from_pylist([{
            "tree": number, "n": len(ids), "width": width,
            **{c: _small(x) for c, x in zip(fields.names[3:], parts)}}], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, labels, held = TaskContext.get().partitionId() << 40, [], [], []
        for batch in batches:
            for i, y, v in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(i)
                labels.append(y)
                held.append(v)
                if len(ids) == TREE:
                    yield tree(number, ids, labels, held)
                    number, ids, labels, held = number + 1, [], [], []
        if ids:
            yield tree(number, ids, labels, held)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select("id", "label", "vector", F.coalesce(F.get("vector", F.lit(lead)), F.lit(0)).alias("lead"))
    return keyed.repartitionByRange(parts, "label", "lead", "id").sortWithinPartitions("label", "lead", "id").select(
        "id", "label", "vector").mapInArrow(run, FOREST)


def _small(x: np.ndarray) -> bytes:
    """The numbers, as 16 bits each where they fit; the first byte tells."""
    fits = not x.size or (x.min() >= -2**15 and x.max() < 2**15)
    return (b"\2" + x.astype("<i2").tobytes()) if fits else (b"\10" + x.astype("<i8").tobytes())


def _large(raw: bytes, width: int = 0) -> np.ndarray:
    x = np.frombuffer(raw, "<i2" if raw[0] == 2 else "<i8", offset=1).astype(np.int64)
    return x.reshape(-1, width) if width else x


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _number_kind(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> type:
    """A type that holds every score exactly."""
    most = max((float(abs(f(x, initial=0))) for x in (q, low, high) for f in (np.min, np.max)), default=0.0)
    own = max(float(abs(np.min(q, initial=0))), float(abs(np.max(q, initial=0))))
    reach = own * most * max(q.shape[1], 1)
    if reach >= LIMIT:
        raise OverflowError("scores beyond 62 bits")
    return np.float64 if reach < 2**53 else np.int64


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with a point of each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return ((up @ low.T + down @ high.T).astype(np.int64), (up @ high.T + down @ low.T).astype(np.int64))


class Anchors:
    """The anchors of a group with their windows: lists of ``low`` and ``high`` scores, ends included."""

    def __init__(self, frame: pd.DataFrame, same: bool) -> None:
        self.number, self.id = frame["number"].to_numpy(), frame["id"].to_numpy()
        self.label, self.same = frame["label"].to_numpy(), same
        self.low = [np.asarray(x, np.int64) for x in frame["low"]]
        self.high = [np.asarray(x, np.int64) for x in frame["high"]]
        width = max((len(v) for v in frame["vector"]), default=0)
        self.q = np.zeros((len(frame), width), np.int64)
        for i, v in enumerate(frame["vector"]):
            self.q[i, :len(v)] = v

    def fits(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a node's labels can hold one that an anchor asks for (anchors x nodes)."""
        own = self.label[:, None]
        return (least <= own) & (own <= most) if self.same else (least != own) | (most != own)


class Best:
    """The best scores of one window, at most ``k``, ties to the smaller id."""

    def __init__(self, low: int, high: int, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """Scores below take no more part."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.floor) & (scores <= self.high)
        if good.any():
            s, i = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
            order = np.lexsort((i, -s))
            s, i = s[order], i[order]
            new = np.ones(len(s), bool)  # an id with several vectors counts by its best
            seen: set[int] = set()
            for at, one in enumerate(i.tolist()):
                new[at] = one not in seen
                seen.add(one)
            self.scores, self.ids = s[new][:self.k], i[new][:self.k]


def best_first(anchors: Anchors, tree: pd.Series, held: list[list[Best]]) -> None:
    """Let one tree's rows into the anchors' windows."""
    width = max(anchors.q.shape[1], tree["width"], 1)
    low, high = (_wide(_large(tree[c], tree["width"]), width) for c in ("low", "high"))
    least, most = _large(tree["least"]), _large(tree["most"])
    q = _wide(anchors.q, width)
    kind = _number_kind(q, low, high)
    q, low, high = q.astype(kind), low.astype(kind), high.astype(kind)
    ids, labels = _large(tree["ids"]), _large(tree["labels"])
    matrix = _wide(_large(tree["matrix"], tree["width"]), width).astype(kind)
    bottom, top = intervals(q, low, high)
    fits = anchors.fits(least, most)
    n_leaves = -(-len(ids) // LEAF)
    first_child, nodes = _children(n_leaves)
    for a, windows in enumerate(held):
        upper, lower, fit = top[a].tolist(), bottom[a].tolist(), fits[a].tolist()

        def open_(node: int) -> bool:
            return fit[node] and any(w.floor <= upper[node] and lower[node] <= w.high for w in windows)

        root = nodes - 1
        queue = [(-upper[root], root)] if open_(root) else []
        while queue:
            _, node = heapq.heappop(queue)
            if not open_(node):
                continue
            if node >= n_leaves:
                start, stop = first_child[node]
                for child in range(start, stop):
                    if open_(child):
                        heapq.heappush(queue, (-upper[child], child))
                continue
            at = slice(node * LEAF, (node + 1) * LEAF)
            scores = (matrix[at] @ q[a]).astype(np.int64)
            eligible = (labels[at] == anchors.label[a]) == anchors.same
            eligible &= ids[at] != anchors.id[a]
            for w in windows:
                w.add(scores[eligible], ids[at][eligible])


def _children(n_leaves: int) -> tuple[dict[int, tuple[int, int]], int]:
    """First and last child of every node above the leaves, and the number of nodes."""
    ranges, begin, n = {}, 0, n_leaves
    while n > 1:
        above = -(-n // FAN)
        for i in range(above):
            ranges[begin + n + i] = (begin + i * FAN, begin + min((i + 1) * FAN, n))
        begin, n = begin + n, above
    return ranges, begin + n


def _needed(anchors: pd.DataFrame, boxes: pd.DataFrame, same: bool) -> pd.DataFrame:
    """Trees that some anchor of the group needs, by their bounding boxes alone."""
    out = pd.DataFrame({"tile": [], "tree": []}, dtype="int64")
    if not len(anchors) or not len(boxes):
        return out
    group = Anchors(anchors, same)
    width = max(group.q.shape[1], int(boxes["width"].max()), 1)
    low, high = (np.concatenate([_wide(_large(b, w), width) for b, w in zip(boxes[c], boxes["width"])])
                 for c in ("low", "high"))
    least, most = (np.concatenate([_large(b) for b in boxes[c]]) for c in ("least", "most"))
    q = _wide(group.q, width)
    kind = _number_kind(q, low, high)
    bottom, top = intervals(q.astype(kind), low.astype(kind), high.astype(kind))
    fits = group.fits(least, most)
    need = np.zeros(len(boxes), bool)
    for a in range(len(anchors)):
        for lo, hi in zip(group.low[a], group.high[a]):
            need |= fits[a] & (top[a] >= lo) & (bottom[a] <= hi)
    return pd.DataFrame({"tile": np.int64(anchors["tile"].iloc[0]), "tree": boxes["tree"].to_numpy()[need]})


def _search(anchors: pd.DataFrame, trees: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    group = Anchors(anchors, same)
    held = [[Best(int(lo), int(hi), k) for lo, hi in zip(group.low[a], group.high[a])] for a in range(len(anchors))]
    for _, tree in trees.iterrows():
        best_first(group, tree, held)
    rows = [(number, w, i, s) for number, windows in zip(group.number.tolist(), held)
            for w, one in enumerate(windows) for s, i in zip(one.scores.tolist(), one.ids.tolist())]
    return pd.DataFrame(rows, columns=["number", "window", "id", "score"])


def search(forest: DataFrame, anchors: DataFrame, tiles: int, same: bool, k: int, made: list[DataFrame]) -> DataFrame:
    """``(number, window, id, score, rank)``: the first ``k`` rows of each window of each anchor.

    ``anchors``: ``number`` (unique), ``tile`` (below ``tiles``), ``id``, ``label``, ``vector``, ``low`` and ``high`` (arrays). Rows
    found have the anchor's label (``same``) or another one.
    """
    def box(c: str) -> Column:
        size = F.when(F.substring(c, 1, 1) == F.lit(b"\2"), 2).otherwise(8)
        each = F.when(F.lit(c in ("low", "high")), F.col("width")).otherwise(1) * size
        return F.concat(F.substring(c, 1, 1), _last_bytes(c, each)).alias(c)

    roots = forest.select("tree", "width", *[box(c) for c in ("low", "high", "least", "most")])
    # groups of trees whose boxes are looked at together: every group of anchors meets all of them
    spans = max(-(-forest.count() // BOXES), 1)
    left = anchors.withColumn("span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))))
    right = roots.withColumn("span", F.pmod(F.xxhash64("tree"), F.lit(spans)).cast("int")).withColumn(
        "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    needed = written(left.groupBy("tile", "span").cogroup(right.groupBy("tile", "span")).applyInPandas(
        lambda a, b: _needed(a, b, same), "tile long, tree long"), "needed", made)
    # few groups of anchors: smaller shares of the trees, so that every core has work
    cores = forest.sparkSession.sparkContext.defaultParallelism
    n = F.count(F.lit(1))
    counts = needed.groupBy("tile").agg(
        F.least(n, F.greatest(F.ceil(n / SPAN), F.lit(-(-cores // tiles)))).alias("parts"))
    shipped = written(needed.join(counts, "tile").select(
        "tile", "tree", F.pmod(F.xxhash64("tree"), "parts").alias("part")), "shipped", made)
    sent = _anew(shipped.join(forest, "tree"))
    asking = _anew(anchors.join(shipped.select("tile", "part").distinct(), "tile"))
    found = asking.groupBy("tile", "part").cogroup(sent.groupBy("tile", "part")).applyInPandas(
        lambda a, b: _search(a, b, same, k), "number long, window int, id long, score long")
    best = found.groupBy("number", "window", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("number", "window").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _anew(df: DataFrame) -> DataFrame:
    """The same columns under new names to the planner, so that both sides of a group may share a table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _hundredth(x: Column) -> Column:
    """A hundredth of a whole number, rounded down, without leaving whole numbers."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100)).cast("long")


def _last_bytes(c: str, n: Column) -> Column:
    """The root's box: the root is the last node."""
    return F.substring(F.col(c), F.octet_length(c) - n + 1, n)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, id_column: str = "vec_id", vector: str = "embedding",
         made: list[DataFrame] | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor's positives are the ``positives`` best other rows of its label; for each, the ``negatives``
    best rows of other labels with ``low`` to ``high`` percent of its score follow.
    """
    made = [] if made is None else made
    rows = written(usable_rows(vectors, label, id_column, vector), "rows", made)
    forest = written(plant(rows), "forest", made)
    # anchors are chosen by a condition on the table's own columns, then matched by row
    chosen = usable_rows(vectors.where(is_anchor), label, id_column, vector)
    numbered = written(chosen.withColumn("number", F.monotonically_increasing_id()), "chosen", made)
    groups = max(-(-numbered.count() // TILE), 1)
    tile = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("long").alias("tile")
    whole = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", -LIMIT), ("high", LIMIT))]
    anchors = numbered.select("*", tile, *whole)
    good = written(search(forest, anchors, groups, True, positives, made).select(
        "number", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        (F.col("rank") - 1).alias("window")), "positives", made)
    # a positive of score p asks for low * p <= 100 * score <= high * p
    p = F.col("positive_score")
    ends = good.select("number", F.struct(
        "window", (-_hundredth(-low * p)).alias("low"), _hundredth(high * p).alias("high")).alias("w"))
    windows = ends.groupBy("number").agg(F.sort_array(F.collect_list("w")).alias("w"))  # ``positives`` at most
    asked = numbered.select("*", tile).join(windows, "number").select(
        "number", "tile", "id", "label", "vector", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    hard = search(forest, asked, groups, False, negatives, made)
    return hard.join(good, ["number", "window"]).join(numbered.select("number", F.col("id").alias("anchor_id")), "number").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
