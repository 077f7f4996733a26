"""The forest against a single machine's on small frames."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickloom.boosting import forest


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(12), rnd.randrange(9), rnd.randrange(7), rnd.randrange(5)) for _ in range(1500)]
    rows = [(*map(float, r), float(rnd.random() < 0.1 + 0.6 * (r[0] > 5) * (r[1] < 4))) for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


def brute(x, y, w, tree, depth, k, seed):
    """Share of positive rows where each row ends; bins are values here."""
    out = np.zeros(len(x))

    def grow(rows, level, node):
        n, good = w[rows].sum(), (w * y)[rows].sum()
        out[rows] = good / n if n else 0
        best = None
        for f in forest.drawn_features(seed, tree, level, x.shape[1], k)[node] if level < depth and 0 < good < n else []:
            for v in np.unique(x[rows, f]):
                left = rows[x[rows, f] <= v]
                ln, ly = w[left].sum(), (w * y)[left].sum()
                if 0 < ln < n:
                    gain = ly**2 / ln + (good - ly) ** 2 / (n - ln) - good**2 / n
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, v)
        if best:
            _, f, v = best
            grow(rows[x[rows, f] <= v], level + 1, 2 * node)
            grow(rows[x[rows, f] > v], level + 1, 2 * node + 1)

    grow(np.arange(len(x)), 0, 0)
    return out


def test_trees_match_brute_force(frame, monkeypatch):
    kept = []
    monkeypatch.setattr(forest, "discard", lambda *made: kept.extend(made))
    model = forest.fit_forest(frame, "m", "features", "label", F.lit(False), trees=5, depth=4, seed=3)
    rows = frame.count()
    x, y, w = [], [], [[] for _ in range(5)]
    for r in kept[0].collect():
        x.append(np.frombuffer(r["bins"], np.uint8).reshape(-1, r["n"]).T.astype(float))
        y.append(np.frombuffer(r["label"]))
        for t in range(5):
            w[t].append(forest.weights(3, t, r["block"], r["n"]).astype(float))
    x, y = np.concatenate(x), np.concatenate(y)
    assert len(x) == rows
    want = sum(brute(x, y, np.concatenate(w[t]), t, 4, 2, 3) for t in range(5)) / 5
    got = sum(t.value[t.of_bins(x.T.astype(np.uint8))] for t in model.trees)
    assert np.allclose(got, want)
    scored = model.transform(frame).select("m_score").toPandas()["m_score"]
    assert abs(scored.mean() - want.mean()) < 1e-9


def test_forest_finds_the_rule(frame):
    model = forest.fit_forest(frame, "m", "features", "label", F.lit(False), trees=40, depth=5)
    scored = model.transform(frame).groupBy(((F.col("a") > 5) & (F.col("b") < 4)).alias("rule")).agg(F.avg("m_score"))
    means = dict(scored.collect())
    assert means[True] > 0.55 and means[False] < 0.25


def test_draws_are_poisson():
    w = forest.weights(1, 2, 3, 200_000)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def test_labels_other_than_0_and_1_are_refused(frame):
    for bad in (2.0, None):
        with pytest.raises(ValueError, match="0 or 1"):
            forest.fit_forest(frame.withColumn("label", F.lit(bad).cast("double")), "m", "features", "label", F.lit(False))
