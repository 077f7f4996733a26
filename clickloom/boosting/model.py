"""Boosted trees as a Spark ML model: scoring, shorter models, gains, saving."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree int, node int, feature int, bin int, threshold double, left int, right int, value double, gain double, rows long"


@dataclass
class Tree:
    """Nodes as arrays, the root first; ``feature`` is -1 in a leaf. Left: at most the threshold."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def _ends(self, goes_right) -> np.ndarray:
        """The leaf of each row; ``goes_right`` tells for split nodes and row numbers."""
        at = None
        while at is None or len(moving):
            if at is None:
                at = goes_right(None, None)
                moving = np.arange(len(at))
            node = at[moving]
            inner = self.feature[node] >= 0
            moving, node = moving[inner], node[inner]
            if len(moving):
                at[moving] = np.where(goes_right(node, moving), self.right[node], self.left[node])
        return at

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; rows go down leaf by leaf, so that each step reads one feature."""
        at = np.zeros(bins.shape[1], np.int64)
        waiting = [(0, np.arange(bins.shape[1]))]
        while waiting:
            node, rows = waiting.pop()
            f = self.feature[node]
            if f < 0 or not len(rows):
                at[rows] = node
                continue
            right = bins[f, rows] > self.bin[node]
            waiting += [(self.left[node], rows[~right]), (self.right[node], rows[right])]
        return at

    def of_values(self, x: np.ndarray) -> np.ndarray:
        # a missing number is not at most the threshold: it goes right
        return self._ends(lambda node, rows: np.zeros(len(x), np.int64) if node is None
                          else ~(x[rows, self.feature[node]] <= self.threshold[node]))


class BoostedTrees(Model, MLWritable, MLReadable):
    """A start value and trees; adds ``<name>_raw`` and, for a probability, ``<name>_score``."""

    def __init__(self, name: str = "model", base: float = 0.0, trees: list[Tree] | None = None,
                 logistic: bool = True, vector: str = "features", history: list[float] | None = None) -> None:
        super().__init__()
        self.name, self.base, self.trees, self.logistic, self.vector = name, base, trees or [], logistic, vector
        self.history = history or []  # the measure of held-out rows after each round that was fitted

    @property
    def getNumTrees(self) -> int:  # noqa: N802  (as Spark's own tree models call it)
        return len(self.trees)

    def prefix(self, n: int) -> BoostedTrees:
        """The model of the first ``n`` rounds: nothing is fitted again."""
        return BoostedTrees(self.name, self.base, self.trees[:n], self.logistic, self.vector, self.history)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, base = self.trees, self.base

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                n = len(batch)
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 1))
                score = np.full(n, base)
                for t in trees:
                    score += t.value[t.of_values(x)]
                yield pa.array(score)

        raw = F.arrow_udf(run, "double")(vector_to_array(F.col(self.vector)))
        out = dataset.withColumn(f"{self.name}_raw", raw)
        score = 1 / (1 + F.exp(-F.col(f"{self.name}_raw"))) if self.logistic else F.col(f"{self.name}_raw")
        return out.withColumn(f"{self.name}_score", score)

    def nodes(self) -> DataFrame:
        """Every node of every tree; as many rows as the settings of the fit allow."""
        rows = [(t, i, *(c[i].item() for c in (
            tree.feature, tree.bin, tree.threshold, tree.left, tree.right, tree.value, tree.gain, tree.rows)))
            for t, tree in enumerate(self.trees) for i in range(len(tree.feature))]
        return SparkSession.active().createDataFrame(rows, NODES)

    def gains(self, features: list[str]) -> DataFrame:
        """``(feature, gain, splits)``: gains of all splits, summed, for every feature."""
        names = SparkSession.active().createDataFrame(list(enumerate(features)), "feature int, name string")
        used = self.nodes().where(F.col("feature") >= 0).groupBy("feature").agg(
            F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
        return names.join(used, "feature", "left").select(
            F.col("name").alias("feature"), F.coalesce("gain", F.lit(0.0)).alias("gain"),
            F.coalesce("splits", F.lit(0).cast("long")).alias("splits"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedTrees) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"booster": {
            "name": m.name, "base": m.base, "logistic": m.logistic, "vector": m.vector, "history": m.history,
            "trees": len(m.trees)}})
        m.nodes().write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTrees:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kept = metadata["booster"]
        rows = self.sparkSession.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        trees = []
        for t in range(kept.pop("trees")):
            own = [r for r in rows if r["tree"] == t]
            column = lambda c: np.array([r[c] for r in own])
            trees.append(Tree(*map(column, ("feature", "bin", "threshold", "left", "right", "value", "gain", "rows"))))
        model = BoostedTrees(trees=trees, **kept)
        model._resetUid(metadata["uid"])
        return model
