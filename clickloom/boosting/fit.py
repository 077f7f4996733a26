"""Fitting boosted trees round by round, judged on held-out rows after each round.

One fit is enough: every round is judged when the next one begins (in the same pass over the rows), training
ends when the best round is ``patience`` rounds back, and the model is cut to its best round. Rows that fit into the
memory of the tasks stay there for many rounds (``together``). Of larger ones scores are kept
with the rows and written anew every ``KEEP`` trees, so a pass adds few trees and lineage stays short; a
model can be continued from its trees. Several models are fitted on the same rows in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from . import together
from .blocks import ARROW, ROWS, SCHEMA, Block, blocks_of, cut_points, lay_out
from .growth import LOSS, Growing, State, finish_small, pass_over, scored
from .model import BoostedTrees, Tree
from .objectives import LISTWISE, LOGISTIC, list_sums

KEEP = 24  # trees after which the kept scores are written anew
AT = 5  # places that mean average precision looks at
MAX_BINS = 256


@dataclass(frozen=True)
class Boosting:
    """Settings of one booster.

    Trees grow best leaf first to ``leaves`` leaves and ``depth`` levels (None: no limit). ``rounds`` is a
    budget: training ends once the held-out measure has not improved for ``patience`` rounds, and the
    best round is kept. Each tree sees ``feature_share`` of the features and ``row_share`` of the
    rows; rows are drawn anew every ``row_every`` trees.
    """

    rounds: int = 1000
    patience: int = 100
    rate: float = 0.05
    depth: int | None = None
    leaves: int = 64
    feature_share: float = 0.8
    row_share: float = 0.8
    row_every: int = 4
    bins: int = 255
    min_rows: int = 20
    min_curvature: float = 1e-3
    l2: float = 0.0
    objective: str = LOGISTIC
    seed: int = 42


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) kept when training waits ``patience`` rounds for a better one, and
    whether the wait is over within ``losses``."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def keep_scores(blocks: DataFrame, since: list[list[Tree]], made: list[DataFrame] | None = None) -> DataFrame:
    """The blocks with the trees' scores added to the kept ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            block.scores = np.array([scored(block, i, trees) for i, trees in enumerate(since)])
            yield pa.RecordBatch.from_pylist([block.row()], schema=ARROW)

    return written(blocks.mapInArrow(run, SCHEMA), "blocks", made)


def average_precisions(score: np.ndarray, label: np.ndarray, mark: np.ndarray, clicks: int, k: int = AT) -> float:
    """Average precision of the ``k`` best rows of one list; ``clicks`` counts the whole list's."""
    order = np.lexsort((mark, -score))[:k]
    hit = label[order] > 0
    return float((hit * np.cumsum(hit) / np.arange(1, len(hit) + 1)).sum() / min(clicks, k))


PARTS = "list long, a double, b double, clicks long, best array<struct<score:double,mark:long,label:double>>, " \
    "held boolean, ap double, n long"


def list_parts(blocks: Iterator[Block], model: int, since: list[Tree]) -> Iterator[dict]:
    """A task's part of the lists that may lie in several blocks, and the sum of the others' average precisions."""
    parts: dict[tuple, list] = {}
    ap, n = [], 0
    for block in blocks:
        score, label = scored(block, model, since), block.label
        a, b = list_sums(score, label, ~block.held)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(block.list) != 0])[:len(label)])
        stops = np.append(starts[1:], len(label))[:len(starts)]
        cut = np.isin(block.list[starts], block.edges)
        for i, j in zip(starts[cut].tolist(), stops[cut].tolist()):
            name, at = int(block.list[i]), slice(i, j)
            for held in (False, True):
                use = np.flatnonzero(block.held[at] == held) + i
                if len(use):
                    best = use[np.lexsort((block.mark[use], -score[use]))[:AT]] if held else use[:0]
                    parts.setdefault((name, held), []).append((
                        float(a[use].sum()), float(b[use].sum()), int((label[use] > 0).sum()),
                        [(float(score[r]), int(block.mark[r]), float(label[r])) for r in best]))
        if not cut.all():
            of = np.repeat(np.arange(len(starts)), stops - starts)
            hit = block.held & (label > 0)
            clicks = np.bincount(of[hit], minlength=len(starts))
            use = np.flatnonzero(block.held & (~cut & (clicks > 0))[of])
            more = precisions_of_lists(of[use], score[use], label[use], block.mark[use], clicks)
            ap, n = [*ap, math.fsum(more)], n + len(more)
    for (name, held), ps in parts.items():
        yield {"list": name, "a": math.fsum(p[0] for p in ps), "b": math.fsum(p[1] for p in ps),
               "clicks": sum(p[2] for p in ps), "held": held, "ap": None, "n": None,
               "best": [dict(zip(("score", "mark", "label"), x)) for x in sorted(
                   (x for p in ps for x in p[3]), key=lambda x: (-x[0], x[1]))[:AT]]}
    yield {"list": None, "a": None, "b": None, "clicks": None, "held": None, "ap": math.fsum(ap), "n": n, "best": []}


def precisions_of_lists(
    of: np.ndarray, score: np.ndarray, label: np.ndarray, mark: np.ndarray, clicks: np.ndarray, k: int = AT,
) -> np.ndarray:
    """Average precision of the ``k`` best rows of every list, by ``average_precisions``, all lists at once.

    ``of`` numbers the lists in the order of the rows; ``clicks`` counts each list's.
    """
    if not len(of):
        return np.empty(0)
    order = np.lexsort((mark, -score, of))
    new = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0]))
    lengths = np.diff(np.append(new, len(of)))
    place = np.arange(len(of)) - np.repeat(new, lengths)
    hit = (label[order] > 0) & (place < k)
    hits = np.cumsum(hit)
    before = np.repeat(hits[new] - hit[new], lengths)
    worth = np.where(hit, (hits - before) / (place + 1), 0.0)
    return np.add.reduceat(worth, new) / np.minimum(clicks[of[new]], k)


def judged_lists(rows) -> tuple[dict[int, tuple[float, float]], float | None]:
    """Sums and mean average precision, from one row per list that lies in several blocks and one for all others."""
    sums, ap, n = {}, 0.0, 0
    for r in rows:
        if r["list"] is None:
            ap, n = ap + r["ap"], n + r["n"]
        elif not r["held"]:
            sums[r["list"]] = (r["a"], r["b"])
        elif r["clicks"]:
            score, mark, label = (np.array([x[c] for x in r["best"]]) for c in ("score", "mark", "label"))
            ap, n = ap + average_precisions(score, label, mark, r["clicks"]), n + 1
    return sums, ap / n if n else None


def lists_of(blocks: DataFrame, model: int, since: list[Tree]) -> tuple[dict[int, tuple[float, float]], float | None]:
    """Sums of the lists that lie in several blocks, and mean average precision of the held-out lists.

    A list inside one block is judged there. Of the others a task tells its sums and its ``AT`` best rows;
    there are at most as many as partitions and lists larger than a block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pa.list_(pa.struct([("score", pa.float64()), ("mark", pa.int64()), ("label", pa.float64())]))
        kinds = [pa.int64(), pa.float64(), pa.float64(), pa.int64(), best, pa.bool_(), pa.float64(), pa.int64()]
        names = ["list", "a", "b", "clicks", "best", "held", "ap", "n"]
        rows = list(list_parts(blocks_of(batches), model, since))
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(names, kinds))))

    # sums in sorted order: the same whichever task ends first
    total = lambda c: F.aggregate(F.sort_array(F.collect_list(c)), F.lit(0.0), lambda x, y: x + y).alias(c)
    return judged_lists(blocks.mapInArrow(run, PARTS).groupBy("list", "held").agg(
        total("a"), total("b"), F.sum("clicks").alias("clicks"), F.flatten(F.collect_list("best")).alias("best"),
        total("ap"), F.sum("n").alias("n")).collect())


def lists_together(block: Block, model: int, talk: together.Alone) -> tuple[dict[int, tuple[float, float]], float | None]:
    """The same among the tasks of one stage."""
    met: dict[tuple, list] = {}
    for told in talk.all(list(list_parts(iter([block]), model, []))):
        for r in told:
            met.setdefault((r["list"], r["held"]), []).append(r)
    rows = []
    for (name, held), parts in met.items():
        total = lambda c: sum(sorted(p[c] for p in parts)) if parts[0][c] is not None else None  # noqa: B023, E731
        rows.append({"list": name, "held": held, **{c: total(c) for c in ("a", "b", "clicks", "ap", "n")},
                     "best": [x for p in parts for x in p["best"]]})
    return judged_lists(rows)


GROWN = "feature", "bin", "left", "right", "best", "sums", "chosen"


class _Fit:
    """The progress of one model."""

    def __init__(self, settings: Boosting, base: float, width: int, trees: list[Tree]) -> None:
        self.settings, self.base, self.width = settings, base, width
        self.trees, self.since, self.history = list(trees), list(trees), []
        self.lists: dict = {}
        self.judged, self.over = False, settings.rounds <= len(trees)
        self.growing: Growing | None = None
        self.kept: list[dict] = []  # what the trees grown in a stage came from

    def begin(self, lists, with_held: bool, small: int | None = None) -> None:
        """A new tree; the trees so far are judged with its first pass. ``lists()`` gives sums and measure."""
        s, t = self.settings, len(self.trees)
        if s.objective == LISTWISE:
            self.lists, measure = lists()
            if with_held and t and measure is not None:
                self.judge(-measure)
        if t >= s.rounds and (s.objective == LISTWISE or not with_held):
            self.over = True
        if self.over:
            return
        rng = np.random.default_rng([s.seed, t])
        n = max(math.ceil(s.feature_share * self.width), 1)
        features = np.sort(rng.choice(self.width, min(n, self.width), replace=False)) if self.width else np.empty(0, int)
        seed = int(np.random.default_rng([s.seed, t // s.row_every, 1]).integers(2**63))
        self.growing = Growing(s, features, seed, small_rows=small)
        if t >= s.rounds:  # nothing more is grown: the last round is judged
            self.growing.asked = []
        self.judged = False

    def judge(self, loss: float) -> None:
        self.history.append(loss)
        self.over = self.over or best_round(self.history, self.settings.patience)[1]

    def state(self, with_held: bool) -> State:
        g = self.growing
        asks_loss = with_held and not self.judged and self.settings.objective != LISTWISE and len(self.trees) > 0
        return State(self.settings, self.since, g.partial(), np.array(g.asked, int), g.features, g.seed, self.lists,
                     asks_loss, np.array(g.small, int), [g.depth[n] for n in g.small])

    def learn(self, found: dict, cuts: list[np.ndarray], unit: float) -> None:
        if LOSS in found:
            self.judge(found.pop(LOSS))
        self.judged = True
        if self.over or len(self.trees) >= self.settings.rounds:
            self.over, self.growing = True, None
            return
        self.growing.learn(found)
        self.ripe(cuts, unit)

    def ripe(self, cuts: list[np.ndarray], unit: float) -> None:
        """A tree that asks for nothing more is done."""
        if not self.growing.asked and not self.growing.small:
            tree = self.growing.finished(cuts, unit)
            self.trees.append(tree)
            self.since.append(tree)
            self.kept.append({c: getattr(self.growing, c) for c in GROWN})
            self.growing = None

    def take(self, told: dict, cuts: list[np.ndarray], unit: float) -> None:
        """The trees and judgements of a stage."""
        for grown in told["kept"]:
            tree = Growing(self.settings, np.empty(0, int), 0, **grown).finished(cuts, unit)
            self.trees.append(tree)
            self.since.append(tree)
        self.history, self.over, self.judged = told["history"], told["over"], told["judged"]


def fit(
    rows: DataFrame, settings: Sequence[Boosting], names: Sequence[str], vector: str = "features", label: str = "label",
    held: Column | None = None, lists: Column | None = None, start: Sequence[BoostedTrees | None] = (),
    whole: bool = False, size: int = ROWS,
) -> list[BoostedTrees]:
    """One model per setting, each cut to its best round (``whole``: with all rounds that were fitted).

    ``held`` rows are not learnt from but choose the round; without any, all rounds are kept. ``lists``
    (a customer, say) is needed by the listwise objective. ``start`` continues earlier models, on the same
    features, up to the rounds of the settings.
    """
    made: list[DataFrame] = []
    held = F.lit(False) if held is None else F.coalesce(held, F.lit(False))
    start = list(start) or [None] * len(settings)
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(held, 1)).alias("held"),
                    F.avg(F.when(~held, F.col(label))).alias("mean")).first()
    with_held, mean = told["held"] > 0, told["mean"] or 0.0
    bins = min(max(s.bins for s in settings), MAX_BINS)
    cuts = cut_points(rows, vector, held, bins, told["n"])
    base = []
    for s, model in zip(settings, start):
        p = min(max(mean, 1e-9), 1 - 1e-9)
        base.append(model.base if model else {LOGISTIC: math.log(p / (1 - p)), LISTWISE: 0.0}.get(s.objective, mean))
    blocks = lay_out(rows, vector, label, held, cuts, base, lists, made, size)
    # whole numbers that stay below 2^62 when all rows are added up
    unit = 2.0 ** -min(30, 62 - max(int(told["n"]), 1).bit_length())
    fits = [_Fit(s, b, len(cuts), [_binned(t, cuts) for t in m.trees] if m else []) for s, b, m in zip(settings, base, start)]
    tasks = together.tasks_for(blocks)
    while tasks and not all(f.over for f in fits):
        told = together.run_stage(blocks, tasks, fits, unit, bins, cuts, with_held, lists_together)
        for f, t in zip(fits, told):
            f.take(t, cuts, unit)
    while not tasks:
        if max(len(f.since) for f in fits) >= KEEP:
            old, blocks = blocks, keep_scores(blocks, [f.since for f in fits], made)
            discard(old)
            made.remove(old)
            for f in fits:
                f.since = []
        for i, f in enumerate(fits):
            if not f.over and f.growing is None:
                f.begin(lambda: lists_of(blocks, i, f.since), with_held)  # noqa: B023
        active = [i for i, f in enumerate(fits) if not f.over]
        if not active:
            break
        # blocks know the models by place: those that are done, or wait, ask for nothing
        asking = [i for i in active if fits[i].growing.asked or not fits[i].judged]
        if asking:
            states = [f.state(with_held) if i in asking else _idle(f) for i, f in enumerate(fits)]
            found = pass_over(blocks, states, unit, bins)
            for i in asking:
                fits[i].learn(found[i], cuts, unit)
        waiting = [i for i in active if fits[i].growing and fits[i].growing.small and not fits[i].growing.asked]
        if waiting:
            states = [f.state(with_held) if i in waiting else _idle(f) for i, f in enumerate(fits)]
            found = finish_small(blocks, states, unit, bins)
            for i in waiting:
                fits[i].growing.graft(found[i])
                fits[i].ripe(cuts, unit)
    discard(*made)
    models = []
    for f, name in zip(fits, names):
        model = BoostedTrees(name, f.base, f.trees, f.settings.objective == LOGISTIC, vector, f.history)
        begun = len(f.trees) - len(f.history)
        models.append(model.prefix(begun + best_round(f.history, f.settings.patience)[0]) if f.history and not whole else model)
    return models


def _idle(f: _Fit) -> State:
    none = np.empty(0, int)
    root = Growing(f.settings, none, 0).partial()
    return State(f.settings, [], root, none, none, 0, {}, False, none, [])


def _binned(tree: Tree, cuts: list[np.ndarray]) -> Tree:
    """A tree of an earlier fit: its thresholds as bins of this one's cut points."""
    at = np.array([np.searchsorted(cuts[f], t) if f >= 0 else -1 for f, t in zip(tree.feature, tree.threshold)])
    return Tree(tree.feature, at, tree.threshold, tree.left, tree.right, tree.value, tree.gain, tree.rows)
