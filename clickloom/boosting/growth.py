"""Growing trees leaf by leaf from histograms that Spark sums up.

A tree asks for the best splits of some of its leaves. ``pass_over`` sends every block's rows down the
trees so far, adds up gradient, curvature and rows per (leaf, feature, bin) within a task, and Spark sums these over all
tasks, runs along the bins and keeps the best split of each leaf. Only those come to the driver.

A leaf with ``SMALL`` rows or fewer has histograms as large as its rows. Such leaves send their rows instead,
each to one task, which grows all that is below it by the same rule (Panda et al. 2009).

The numbers are whole (fixed point), so sums do not depend on the order in which tasks end, and a tree
is the same however the rows are dealt.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, blocks_of
from .model import Tree
from .objectives import gradients

PARTIAL = "model int, leaf int, feature int, bin int, g long, h long, n long"
NAMES = ["model", "leaf", "feature", "bin", "g", "h", "n"]
SMALL = 65_536  # rows of a leaf that one task finishes
LOSS = -1  # the leaf number of rows that carry a held-out loss


@dataclass
class Growing:
    """A tree that grows: nodes as lists, and the best known split of each."""

    settings: object
    features: np.ndarray
    seed: int
    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [-1])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    depth: list = field(default_factory=lambda: [0])
    best: dict = field(default_factory=dict)  # node -> (gain, feature, bin, sums left, sums right)
    sums: dict = field(default_factory=dict)  # node -> (g, h, n)
    asked: list = field(default_factory=lambda: [0])
    small: list = field(default_factory=list)  # leaves to be finished by one task each
    chosen: list = field(default_factory=list)
    small_rows: int | None = None  # instead of ``SMALL``

    def learn(self, found: dict[int, tuple]) -> None:
        """Take the answers to ``asked``: (gain or None, feature, bin, left sums, all sums) per node."""
        for node in self.asked:
            if node in found:
                gain, feature, at, left, whole = found[node]
                self.sums[node] = whole
                if gain is not None and gain > 0:
                    self.best[node] = (gain, feature, at, left)
        self.asked = []
        self._select()

    def _open(self, node: int) -> None:
        gain, feature, at, left = self.best[node]
        self.feature[node], self.bin[node] = feature, at
        whole = self.sums[node]
        for side, sums in ((self.left, left), (self.right, tuple(a - b for a, b in zip(whole, left)))):
            child = len(self.feature)
            side[node] = child
            for column in (self.feature, self.bin, self.left, self.right):
                column.append(-1)
            self.depth.append(self.depth[node] + 1)
            self.sums[child] = sums
            if self._may_split(child):
                small = SMALL if self.small_rows is None else self.small_rows
                (self.small if sums[2] <= small else self.asked).append(child)

    def graft(self, found: dict[int, list[tuple]]) -> None:
        """Take the answers to ``small``: the nodes below each leaf, the leaf first, as ``finish`` gives them."""
        for leaf in self.small:
            below = found.get(leaf, [])
            number = {0: leaf}
            for i, (gain, feature, at, left, right, lsums, wsums) in enumerate(below):
                node = number[i]
                self.sums[node] = wsums
                if gain is None:
                    continue
                self.best[node] = (gain, feature, at, lsums)
                if left >= 0:
                    self.feature[node], self.bin[node] = feature, at
                    for side, child in ((self.left, left), (self.right, right)):
                        number[child] = side[node] = len(self.feature)
                        for column in (self.feature, self.bin, self.left, self.right):
                            column.append(-1)
                        self.depth.append(self.depth[node] + 1)
        self.small = []
        self._select()

    def _may_split(self, node: int) -> bool:
        s = self.settings
        return (s.depth is None or self.depth[node] < s.depth) and self.sums[node][2] >= 2 * s.min_rows

    def _select(self) -> None:
        """Best first: the order of splits, as far as it is known. Leaves that could be among the next ones
        are opened together, so that one pass answers for all of them."""
        limit = self.settings.leaves - 1
        while True:
            queue = [(-self.best[0][0], 0)] if 0 in self.best else []
            self.chosen = []
            while queue and len(self.chosen) < limit:
                _, node = heapq.heappop(queue)
                if self.feature[node] < 0:  # its children are not known yet
                    break
                self.chosen.append(node)
                for child in (self.left[node], self.right[node]):
                    if child in self.best:
                        heapq.heappush(queue, (-self.best[child][0], child))
            else:
                return
            before = len(self.small)
            for _, other in heapq.nsmallest(limit - len(self.chosen), [(-self.best[node][0], node), *queue]):
                if self.feature[other] < 0:
                    self._open(other)
            if self.asked or len(self.small) > before:
                return

    def finished(self, cuts: list[np.ndarray], unit: float) -> Tree:
        """The chosen splits as a tree; the weight of a leaf is minus gradient by curvature."""
        s, keep = self.settings, set(self.chosen)
        order, number = [0], {0: 0}
        for node in order:
            if node in keep:
                for child in (self.left[node], self.right[node]):
                    number[child] = len(order)
                    order.append(child)
        inner = [n in keep for n in order]

        def weight(node: int) -> float:
            g, h, _ = self.sums.get(node, (0, 0, 0))
            g, h = g * unit, h * unit
            return -s.rate * g / (h + s.l2) if h + s.l2 > 0 else 0.0

        pick = lambda source, other: np.array([source(n) if k else other for n, k in zip(order, inner)])
        return Tree(
            pick(lambda n: self.feature[n], -1), pick(lambda n: self.bin[n], -1),
            pick(lambda n: float(cuts[self.feature[n]][self.bin[n]]), np.nan).astype(float),
            pick(lambda n: number[self.left[n]], -1), pick(lambda n: number[self.right[n]], -1),
            np.array([0.0 if k else weight(n) for n, k in zip(order, inner)]),
            pick(lambda n: self.best[n][0], 0.0).astype(float),
            np.array([int(self.sums.get(n, (0, 0, 0))[2]) for n in order], np.int64))

    def partial(self) -> Tree:
        """All nodes opened so far, to send rows down."""
        n = len(self.feature)
        none = np.zeros(n)
        return Tree(np.array(self.feature), np.array(self.bin), none, np.array(self.left), np.array(self.right),
                    none, none, none)


@dataclass
class State:
    """What a pass needs of one model: kept in the task's closure, bounded by the settings."""

    settings: object
    since: list[Tree]  # trees that the kept scores do not contain yet
    growing: Tree
    asked: np.ndarray
    features: np.ndarray
    seed: int
    lists: dict  # sums of lists that lie in several blocks
    loss: bool
    small: np.ndarray
    small_depth: list


def drawn(mark: np.ndarray, seed: int, share: float) -> np.ndarray:
    """About ``share`` of the rows, by their marks."""
    x = mark.astype(np.uint64) ^ np.uint64(seed % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(32)) < np.uint64(int(share * 2**32))


def best_of(hist: np.ndarray, s, unit: float) -> tuple | None:
    """The best split from sums (3 x features x bins), by the same rule as ``best_splits``."""
    left = np.cumsum(hist, axis=2)
    whole = left[:, :1, -1:]
    right = whole - left

    def quality(x):
        g, h = x[0] * unit, x[1] * unit + s.l2
        return np.divide(g * g, h, out=np.zeros(np.broadcast(g, h).shape), where=h > 0)

    gain = quality(left) + quality(right) - quality(whole)
    good = (left[2] >= s.min_rows) & (right[2] >= s.min_rows) & (right[2] > 0) & (left[2] > 0)
    good &= (left[1] * unit >= s.min_curvature) & (right[1] * unit >= s.min_curvature)
    gain = np.where(good, gain, -np.inf)
    at = int(np.argmax(gain))  # the first of equal ones: smaller feature, then smaller bin
    f, b = divmod(at, gain.shape[1])
    if not gain[f, b] > 0:
        return None
    return float(gain[f, b]), f, b, tuple(int(x) for x in left[:, f, b])


def finish(bins: np.ndarray, g: np.ndarray, h: np.ndarray, s, depth: int, unit: float, width: int) -> list[tuple]:
    """Grow a small leaf, best first: ``(gain, feature, bin, left, right, left sums, all sums)`` per node."""
    nodes, rows_of, depths, queue = [], [], [], []

    def add(rows: np.ndarray, depth: int) -> int:
        whole = (int(g[rows].sum()), int(h[rows].sum()), len(rows))
        found = None
        if len(bins) and len(rows) >= 2 * s.min_rows and (s.depth is None or depth < s.depth):
            key = (bins[:, rows].astype(np.int64) + (np.arange(len(bins)) * width)[:, None]).ravel()
            n = len(bins) * width
            hist = np.array([np.bincount(key, w, minlength=n) for w in (
                np.tile(g[rows], len(bins)), np.tile(h[rows], len(bins)), None)]).astype(np.int64)
            found = best_of(hist.reshape(3, len(bins), width), s, unit)
        number = len(nodes)
        gain, f, b, left = found or (None, -1, -1, (0, 0, 0))
        nodes.append([gain, f, b, -1, -1, left, whole])
        rows_of.append(rows)
        depths.append(depth)
        if found:
            heapq.heappush(queue, (-gain, number))
        return number

    add(np.arange(bins.shape[1]), depth)
    for _ in range(s.leaves - 1):
        if not queue:
            break
        _, node = heapq.heappop(queue)
        f, b = nodes[node][1:3]
        rows, rows_of[node] = rows_of[node], None
        right = bins[f, rows] > b
        nodes[node][3] = add(rows[~right], depths[node] + 1)
        nodes[node][4] = add(rows[right], depths[node] + 1)
    return [tuple(n) for n in nodes]


SMALL_ROWS = "model int, leaf int, n int, bins binary, g binary, h binary"
BELOW = "model int, leaf int, node int, gain double, feature int, bin int, `left` int, `right` int, " \
    "lg long, lh long, ln long, wg long, wh long, wn long"


def _rows_of_small(batches: Iterator[pa.RecordBatch], states: list[State], unit: float) -> Iterator[pa.RecordBatch]:
    """The rows of small leaves, one output row per leaf and block."""
    schema = pa.schema([("model", pa.int32()), ("leaf", pa.int32()), ("n", pa.int32()),
                        ("bins", pa.binary()), ("g", pa.binary()), ("h", pa.binary())])
    for block in blocks_of(batches):
        out = []
        for i, s in enumerate(states):
            if not len(s.small):
                continue
            g, h = (np.rint(x / unit).astype("<i8") for x in gradients(
                s.settings.objective, scored(block, i, s.since), block, s.lists))
            use = ~block.held
            if s.settings.row_share < 1:
                use &= drawn(block.mark, s.seed, s.settings.row_share)
            leaf = np.where(use, s.growing.of_bins(block.bins), -1)
            order = np.argsort(leaf, kind="stable")
            for number in s.small.tolist():
                lo, hi = np.searchsorted(leaf[order], [number, number + 1])
                rows = order[lo:hi]
                if len(rows):
                    out.append({"model": i, "leaf": number, "n": len(rows),
                                "bins": block.bins[np.ix_(s.features, rows)].tobytes(),
                                "g": g[rows].tobytes(), "h": h[rows].tobytes()})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def finish_small(blocks: DataFrame, states: list[State], unit: float, width: int) -> list[dict]:
    """What grows below every small leaf, per model."""
    depths = [dict(zip(s.small.tolist(), s.small_depth)) for s in states]
    settings, features = [s.settings for s in states], [s.features for s in states]

    def below(frame):
        import pandas as pd

        i, leaf = int(frame["model"].iloc[0]), int(frame["leaf"].iloc[0])
        bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, n) for b, n in zip(frame["bins"], frame["n"])], axis=1)
        g, h = (np.concatenate([np.frombuffer(x, "<i8") for x in frame[c]]) for c in "gh")
        nodes = finish(bins, g, h, settings[i], depths[i][leaf], unit, width)
        real = [int(features[i][n[1]]) if n[1] >= 0 else -1 for n in nodes]
        rows = [(i, leaf, k, n[0], f, n[2], n[3], n[4], *n[5], *n[6]) for k, (n, f) in enumerate(zip(nodes, real))]
        return pd.DataFrame(rows, columns=["model", "leaf", "node", "gain", "feature", "bin", "left", "right",
                                           "lg", "lh", "ln", "wg", "wh", "wn"])

    rows = blocks.mapInArrow(lambda b: _rows_of_small(b, states, unit), SMALL_ROWS).groupBy(
        "model", "leaf").applyInPandas(below, BELOW).collect()
    out: list[dict] = [{} for _ in states]
    for r in sorted(rows, key=lambda r: (r["model"], r["leaf"], r["node"])):
        gain = r["gain"] if r["feature"] >= 0 else None
        out[r["model"]].setdefault(r["leaf"], []).append((
            gain, r["feature"], r["bin"], r["left"], r["right"],
            (r["lg"], r["lh"], r["ln"]), (r["wg"], r["wh"], r["wn"])))
    return out


def scored(block: Block, i: int, since: list[Tree]) -> np.ndarray:
    score = block.scores[i].copy()
    for t in since:
        score += t.value[t.of_bins(block.bins)]
    return score


def partial_sums(batches: Iterator[pa.RecordBatch], states: list[State], unit: float, width: int) -> Iterator[pa.RecordBatch]:
    """One task's sums per (model, leaf, feature, bin)."""
    held = [np.zeros((3, len(s.asked), len(s.features), width), np.int64) for s in states]
    losses = np.zeros((len(states), 2), np.int64)
    for block in blocks_of(batches):
        for i, s in enumerate(states):
            score = scored(block, i, s.since)
            if s.loss and block.held.any():
                p = score[block.held]
                each = np.logaddexp(0, np.where(block.label[block.held] > 0, -p, p))
                losses[i] += int(np.rint(np.minimum(each, 64) / unit / 64).sum()), len(p)
            if not len(s.asked):
                continue
            g, h = gradients(s.settings.objective, score, block, s.lists)
            use = ~block.held
            if s.settings.row_share < 1:
                use &= drawn(block.mark, s.seed, s.settings.row_share)
            place = np.full(len(s.growing.feature), -1)
            place[s.asked] = np.arange(len(s.asked))
            leaf = place[s.growing.of_bins(block.bins)]
            rows = np.flatnonzero(use & (leaf >= 0))
            key, n = leaf[rows] * width, len(s.asked) * width
            whole = [np.rint(x[rows] / unit) for x in (g, h)]
            for j, f in enumerate(s.features):
                at = key + block.bins[f, rows]
                for k, weights in enumerate((*whole, None)):
                    # whole numbers below 2^53 in all: exact
                    held[i][k, :, j] += np.bincount(at, weights, minlength=n).astype(np.int64).reshape(-1, width)
    columns = [[] for _ in NAMES]
    for i, s in enumerate(states):
        leaf, j, b = np.nonzero(held[i][2])
        g, h, n = (held[i][k][leaf, j, b] for k in range(3))
        parts = [np.full(len(leaf), i), s.asked[leaf] if len(leaf) else leaf, s.features[j] if len(leaf) else j, b, g, h, n]
        if losses[i, 1]:
            parts = [np.append(p, x) for p, x in zip(parts, (i, LOSS, -1, -1, losses[i, 0], 0, losses[i, 1]))]
        for c, p in zip(columns, parts):
            c.append(p)
    kinds = [pa.int32()] * 4 + [pa.int64()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)], NAMES)


def best_splits(sums: DataFrame, l2: list[float], min_rows: list[int], min_h: list[float], unit: float) -> DataFrame:
    """The best split of each (model, leaf), from sums per (model, leaf, feature, bin).

    ``gain`` is what the split adds to gradient^2 / (curvature + l2); null where no split is allowed. Ties
    go to the feature that comes first, then to the smaller bin. As SQL text: a fit runs this some
    hundred times, and building the same columns one by one took longer than the query.
    """
    of = lambda values, kind: f"element_at(array({', '.join(f'cast({v!r} as {kind})' for v in values)}), model + 1)"
    quality = lambda g, h: f"if({h} > 0, ({g}) * ({g}) / ({h}), 0d)"
    part = "partition by model, leaf, feature"
    return sums.sparkSession.sql(f"""
        with along as (
          select model, leaf, feature, bin, {of(l2, 'double')} as l2, {of(min_rows, 'long')} as rows_, {of(min_h, 'double')} as h_,
            sum(g) over (run) as lg, sum(h) over (run) as lh, sum(n) over (run) as ln,
            sum(g) over ({part}) as wg, sum(h) over ({part}) as wh, sum(n) over ({part}) as wn
          from {{sums}} window run as ({part} order by bin rows between unbounded preceding and current row)),
        judged as (
          select model, leaf, struct(feature, bin, lg, lh, ln, wg, wh, wn, if(
              ln >= rows_ and wn - ln >= rows_ and wn > ln and lh * {unit!r}d >= h_ and (wh - lh) * {unit!r}d >= h_,
              {quality(f'lg * {unit!r}d', f'(lh * {unit!r}d + l2)')}
                + {quality(f'(wg - lg) * {unit!r}d', f'((wh - lh) * {unit!r}d + l2)')}
                - {quality(f'wg * {unit!r}d', f'(wh * {unit!r}d + l2)')}, null) as gain) as s
          from along)
        select model, leaf, s.* from (
          select model, leaf, max_by(s, struct(coalesce(s.gain, double('-Infinity')), -s.feature, -s.bin)) as s
          from judged group by model, leaf)""", sums=sums)


def pass_over(blocks: DataFrame, states: list[State], unit: float, width: int) -> list[dict]:
    """Best splits of all leaves asked for, and held-out losses, per model."""
    partial = blocks.mapInArrow(lambda b: partial_sums(b, states, unit, width), PARTIAL)
    # dealt by (model, leaf, feature) once: sums, running sums and choice follow without another shuffle of them
    sums = partial.repartition("model", "leaf", "feature").groupBy("model", "leaf", "feature", "bin").agg(
        *[F.expr(f"sum({c}) as {c}") for c in "ghn"])
    s = [x.settings for x in states]
    rows = best_splits(sums, [x.l2 for x in s], [x.min_rows for x in s], [x.min_curvature for x in s], unit).collect()
    out = [{} for _ in states]
    for r in rows:
        if r["leaf"] == LOSS:
            out[r["model"]][LOSS] = r["wg"] * unit * 64 / r["wn"]
        else:
            out[r["model"]][r["leaf"]] = (
                r["gain"], r["feature"], r["bin"], (r["lg"], r["lh"], r["ln"]), (r["wg"], r["wh"], r["wn"]))
    return out
