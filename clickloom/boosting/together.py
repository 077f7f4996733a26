"""Rounds of boosting inside one barrier stage.

A tree takes some ten passes over the rows, and a pass as a job of its own waits for planning, reading and a
shuffle each time. Here every task keeps its blocks in memory, and all tasks grow the same trees side by side: each
adds up the sums of its own rows, gives every other task those of its share of the features, and finds the best splits
of its own share from the sums of all. Then all tell each other these, and take the same splits from the same whole
numbers. A stage grows up to ``STAGE`` trees of each model and returns them, so that a lost executor costs one stage.

Tasks tell each other by files in the shared folder, where that is a folder of the file system: some milliseconds each
time. Elsewhere, or if a task does not see the others' files, ``allGather`` carries the same; it takes about a second
however little it carries, so a task gets more rows then. One task alone tells nobody.

Of two children only the one with fewer rows is counted; the other has what is left of its parent's sums.

Rows must fit into the tasks' memory (``HELD`` bytes each); larger ones are passed over from files, job by job.
"""

from __future__ import annotations

import base64
import os
import pickle
import re
import time
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, shared_folder
from .blocks import Block, blocks_of
from .growth import LOSS, best_of, drawn, scored
from .objectives import gradients

STAGE = 250  # trees of a model in one stage
PER_TASK = 8  # blocks of a task
SLOW = 8  # times as many blocks where tasks cannot tell each other by files
SEEN = 5.0  # seconds after which another task's file must be there at the start
HELD = 1 << 29  # bytes of blocks that a task keeps
RESULT = "kept", "history", "over", "judged"


def slots(spark: SparkSession) -> int:
    """Tasks that surely run at the same time; 0 where that is not known."""
    sc, conf = spark.sparkContext, spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0  # Spark has no barrier stages then
    cluster = re.fullmatch(r"local-cluster\[\s*(\d+)\s*,\s*(\d+)\s*,.*\]", sc.master)
    cores = int(cluster[1]) * int(cluster[2]) if cluster else 0
    if sc.master.startswith("local") and not cluster:
        named = re.match(r"local\[(\d+)", sc.master)
        cores = int(named[1]) if named else 1 if sc.master == "local" else sc.defaultParallelism
    elif conf.get("spark.executor.cores", None):
        executors = len(sc._jsc.sc().statusTracker().getExecutorInfos()) - 1  # the driver is one of them
        cores = executors * int(conf.get("spark.executor.cores"))
    elif not cores and not conf.get("spark.default.parallelism", None):
        cores = sc.defaultParallelism
    return cores // int(conf.get("spark.task.cpus", "1"))


def folder_of_files(spark: SparkSession) -> str | None:
    """The shared folder as a path that Python's ``open`` knows; None on other file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def tasks_for(blocks: DataFrame) -> int:
    """Tasks that hold all blocks in memory; 0 if they do not fit, or if there are none."""
    there = slots(blocks.sparkSession)
    size = sum((F.length(c) for c in ("bins", "label", "held", "mark", "list", "scores")), F.lit(0))
    told = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("bytes")).first()
    per = PER_TASK * (1 if folder_of_files(blocks.sparkSession) else SLOW)
    tasks = min(there, -(-told["n"] // per))
    return tasks if (told["bytes"] or 0) <= tasks * HELD else 0


def one_block(blocks: list[Block], width: int, models: int) -> Block:
    """All blocks of a task as one. Lists that may go on elsewhere keep their mark."""
    if not blocks:
        none = np.empty(0)
        return Block(np.empty((width, 0), np.uint8), none, none.astype(bool), none.astype("<i8"), none.astype("<i8"),
                     none.astype("<i8"), np.empty((models, 0)))
    join = lambda c, axis=0: np.concatenate([getattr(b, c) for b in blocks], axis=axis)
    return Block(join("bins", 1), join("label"), join("held"), join("mark"), join("list"), np.unique(join("edges")),
                 join("scores", 1))


def packed(what) -> str:
    return base64.b64encode(zlib.compress(pickle.dumps(what, protocol=5), 1)).decode()


def unpacked(text: str):
    return pickle.loads(zlib.decompress(base64.b64decode(text)))


class Alone:
    """One task talks to itself."""

    n, me = 1, 0

    def all(self, what) -> list:
        """What every task tells, in the tasks' order."""
        return [what]

    def deal(self, parts: list) -> list:
        """What every task has for this one; ``parts`` holds one for each task."""
        return parts


class Gather(Alone):
    """Tasks of a barrier stage tell each other through Spark."""

    def __init__(self, context: BarrierTaskContext) -> None:
        self.n, self.me, self.context = len(context.getTaskInfos()), context.partitionId(), context

    def all(self, what) -> list:
        return [unpacked(t) for t in self.context.allGather(packed(what))]

    def deal(self, parts: list) -> list:
        return [told[self.me] for told in self.all(parts)]


class Files(Alone):
    """Tasks of a barrier stage tell each other by files in a folder that all of them see.

    A file is whole once it has its name. Who has read all files of a step knows that all have read those of the
    step before, and deletes its own.
    """

    def __init__(self, context: BarrierTaskContext, folder: str) -> None:
        self.n, self.me, self.step, self.folder = len(context.getTaskInfos()), context.partitionId(), 0, folder
        os.makedirs(folder, exist_ok=True)

    def path(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def write(self, parts: list) -> None:
        told = [pickle.dumps(p, protocol=5) for p in parts]
        ends = np.cumsum([0, *map(len, told)]).astype("<i8")
        name = self.path(self.step, self.me)
        with open(f"{name}.begun", "wb") as f:
            f.write(ends.tobytes())
            f.writelines(told)
        os.rename(f"{name}.begun", name)

    def read(self, task: int, n: int, part: int):
        """Part ``part`` of ``n`` of what ``task`` has written. Where a task fails, Spark ends all of the stage."""
        wait = 0.0005
        while True:
            try:
                with open(self.path(self.step, task), "rb") as f:
                    ends = np.frombuffer(f.read(8 * (n + 1)), "<i8")
                    f.seek(8 * (n + 1) + int(ends[part]))
                    return pickle.loads(f.read(int(ends[part + 1] - ends[part])))
            except FileNotFoundError:
                time.sleep(wait)
                wait = min(1.3 * wait, 0.02)

    def told(self, parts: list, part: int) -> list:
        self.write(parts)
        found = [self.read(k, len(parts), part) for k in range(self.n)]
        if self.step:
            os.remove(self.path(self.step - 1, self.me))
        self.step += 1
        return found

    def all(self, what) -> list:
        return self.told([what], 0)

    def deal(self, parts: list) -> list:
        return self.told(parts, self.me)


def seen(paths: list[str]) -> bool:
    """Whether the files are there, now or soon."""
    begun = time.monotonic()
    while not all(map(os.path.exists, paths)):
        if time.monotonic() - begun > SEEN:
            return False
        time.sleep(0.05)
    return True


def talk(context: BarrierTaskContext | None, folder: str | None) -> Alone:
    """How this task talks to the others of its stage; all of them choose alike."""
    if context is None:
        return Alone()
    if folder:
        me = str(context.taskAttemptId())
        try:
            os.makedirs(folder, exist_ok=True)
            open(f"{folder}/{me}.here", "w").close()
        except OSError:
            pass  # the others will not see it
        names = context.allGather(me)
        if all(context.allGather("seen" if seen([f"{folder}/{name}.here" for name in names]) else "")):
            return Files(context, f"{folder}/{names[0]}")  # another attempt of the stage has other names
    return Gather(context)


class Rows:
    """One task's rows: the leaf that each has reached in the tree that grows, and its gradients."""

    def __init__(self, block: Block, models: int, unit: float, width: int, talk: Alone) -> None:
        self.block, self.unit, self.width, self.talk = block, unit, width, talk
        self.now: list[dict | None] = [None] * models

    def begin(self, i: int, state) -> None:
        b = self.block
        g, h = gradients(state.settings.objective, b.scores[i], b, state.lists) if len(b.label) else (b.label, b.label)
        use = ~b.held
        if state.settings.row_share < 1:
            use &= drawn(b.mark, state.seed, state.settings.row_share)
        # whole numbers below 2^53 in all: exact
        self.now[i] = {"g": np.rint(g / self.unit), "h": np.rint(h / self.unit), "rows": {0: np.flatnonzero(use)}, "sums": {}}

    def to_count(self, i: int, growing) -> tuple[list[int], list[tuple[int, int, int]]]:
        """Leaves whose rows are counted, and the others as (leaf, parent, its other child)."""
        rows, counted, left_over = self.now[i]["rows"], [], []
        asked = set(growing.asked)
        parents = {c: p for p, sides in enumerate(zip(growing.left, growing.right)) for c in sides if c in asked}
        for p in sorted(set(parents.values())):
            here = rows.pop(p)
            right = self.block.bins[growing.feature[p], here] > growing.bin[p]
            sides = {growing.left[p]: here[~right], growing.right[p]: here[right]}
            rows.update(sides)
            few, many = sorted(sides, key=lambda c: (growing.sums[c][2], c))
            counted.append(few)
            if many in asked:
                left_over.append((many, p, few))
        return [*(c for c in growing.asked if c not in parents), *counted], left_over

    def loss(self, i: int, state) -> tuple[int, int]:
        """The held-out loss, if it is asked for, and of how many rows."""
        b = self.block
        if not state.loss or not b.held.any():
            return 0, 0
        p = b.scores[i][b.held]
        each = np.logaddexp(0, np.where(b.label[b.held] > 0, -p, p))
        return int(np.rint(np.minimum(each, 64) / self.unit / 64).sum()), len(p)

    def sums(self, i: int, state, counted: list[int]) -> list[list[tuple]]:
        """Per task, sums per (feature of its share, leaf, bin) where there are rows."""
        now, width = self.now[i], self.width
        here = np.concatenate([now["rows"][c] for c in counted]) if counted else np.empty(0, np.int64)
        key = np.repeat(np.arange(len(counted)) * width, [len(now["rows"][c]) for c in counted])
        g, h, n = now["g"][here], now["h"][here], len(counted) * width
        parts: list[list[tuple]] = [[] for _ in range(self.talk.n)]
        for j, f in enumerate(state.features.tolist()):
            cell = key + self.block.bins[f, here]
            count = np.bincount(cell, minlength=n)
            there = np.flatnonzero(count)
            parts[j % self.talk.n].append((
                there.astype(np.int32), np.bincount(cell, g, n)[there].astype(np.int64),
                np.bincount(cell, h, n)[there].astype(np.int64), count[there].astype(np.int32)))
        return parts

    def best_of_share(self, i: int, state, told: list, counted: list[int], left_over: list[tuple]) -> dict[int, tuple]:
        """The best split of every leaf asked for among this task's share of the features."""
        known, mine = self.now[i]["sums"], state.features[self.talk.me::self.talk.n]
        whole = np.zeros((3, len(mine), len(counted) * self.width), np.int64)
        for parts in told:
            for j, (cells, *sums) in enumerate(parts):
                for k in range(3):
                    whole[k, j, cells] += sums[k]
        whole = whole.reshape(3, len(mine), len(counted), self.width)
        for a, leaf in enumerate(counted):
            known[leaf] = whole[:, :, a].copy()
        for leaf, parent, other in left_over:
            known[leaf] = known[parent] - known[other]
        found = {}
        for leaf in state.asked.tolist():
            total = tuple(int(x) for x in known[leaf][:, 0].sum(axis=1)) if len(mine) else (0, 0, 0)
            if total[2]:
                gain, f, at, left = best_of(known[leaf], state.settings, self.unit) or (None, 0, -1, (0, 0, 0))
                found[leaf] = gain, int(mine[f]), at, left, total
        return found

    def best(self, asking: dict[int, tuple]) -> dict[int, dict]:
        """The best split of every leaf asked for, and the held-out loss, from the rows of all tasks.

        ``asking``: the state and the growing tree of each model.
        """
        parts: list[dict] = [{} for _ in range(self.talk.n)]
        ways = {}
        for i, (state, growing) in asking.items():
            loss, sums = self.loss(i, state), [[] for _ in parts]
            if len(state.asked) and len(state.features):
                if self.now[i] is None:
                    self.begin(i, state)
                ways[i] = self.to_count(i, growing)
                sums = self.sums(i, state, ways[i][0])
            for part, share in zip(parts, sums):
                part[i] = loss, share
        told = self.talk.deal(parts)
        shares = {i: self.best_of_share(i, asking[i][0], [t[i][1] for t in told], *way) for i, way in ways.items()}
        for i, (_, growing) in asking.items():
            if i in ways:  # sums of leaves that are split now, or never will be, are not needed again
                keep = {*growing.asked, *(c for c in growing.best if growing.left[c] < 0)}
                self.now[i]["sums"] = {c: x for c, x in self.now[i]["sums"].items() if c in keep}
        found: dict[int, dict] = {i: {} for i in asking}
        for i, out in found.items():
            loss, n = (sum(t[i][0][k] for t in told) for k in range(2))
            if n:
                out[LOSS] = loss * self.unit * 64 / n
        for share in self.talk.all(shares):
            for i, leaves in share.items():
                for leaf, split in leaves.items():
                    # of equal ones the smaller feature
                    rank = lambda s: (s[0] is not None, s[0] or 0.0, -s[1])
                    if leaf not in found[i] or rank(split) > rank(found[i][leaf]):
                        found[i][leaf] = split
        return found

    def add(self, i: int, trees: list) -> None:
        """The scores with finished trees."""
        if len(self.block.label):
            self.block.scores[i] = scored(self.block, i, trees)
        self.now[i] = None


def run_stage(blocks: DataFrame, tasks: int, fits: list, unit: float, width: int, cuts: list[np.ndarray],
              with_held: bool, lists_of: Callable) -> list[dict]:
    """What every model has after up to ``STAGE`` more trees: its grown trees, history and whether it is over.

    ``lists_of(block, model, talk)`` gives the sums of lists that lie with several tasks, and the measure.
    """
    began = [len(f.trees) for f in fits]
    spark, folder = blocks.sparkSession, None
    if tasks > 1 and folder_of_files(spark):
        folder = f"{folder_of_files(spark)}/clickloom/told-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get() if tasks > 1 else None
        block = one_block(list(blocks_of(batches)), len(cuts), len(fits))
        rows = Rows(block, len(fits), unit, width, talk(context, folder))
        while True:
            for i, f in enumerate(fits):
                if f.since:
                    rows.add(i, f.since)
                    f.since = []
                if not f.over and f.growing is None and len(f.trees) < began[i] + STAGE:
                    f.begin(lambda: lists_of(rows.block, i, rows.talk), with_held, small=0)  # noqa: B023
            active = [i for i, f in enumerate(fits) if f.growing is not None and not f.over]
            if not active:
                break
            found = rows.best({i: (fits[i].state(with_held), fits[i].growing) for i in active})
            for i in active:
                fits[i].learn(found[i], cuts, unit)
        if context is None or context.partitionId() == 0:
            told = [{c: getattr(f, c) for c in RESULT} for f in fits]
            yield pa.RecordBatch.from_pylist([{"told": pickle.dumps(told)}], schema=pa.schema([("told", pa.binary())]))

    dealt = blocks.repartition(tasks).mapInArrow(run, "told binary", barrier=tasks > 1)
    try:
        return pickle.loads(dealt.collect()[0]["told"])
    finally:
        if folder:
            remove(spark, folder)
