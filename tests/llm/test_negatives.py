"""Mining against all pairs, and the parts of the tree."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score double"


def brute(rows, every, n_pos, n_neg, low=30, high=90):
    good = {(i, y, tuple(int(np.floor(256 * x)) for x in v)) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}

    def best(options, n):
        scores = {}
        for i, s in options:
            scores[i] = max(s, scores.get(i, s))
        return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:n]

    out = []
    for a, y, v in good:
        if a % every == 0:
            scored = [(i, z, sum(p * q for p, q in zip(v, w))) for i, z, w in good if i != a]
            for pos, ps in best([(i, s) for i, z, s in scored if z == y], n_pos):
                window = [(i, s) for i, z, s in scored if z != y and low * ps <= 100 * s <= high * ps]
                out += [(a, pos, rank, i, ps, s) for rank, (i, s) in enumerate(best(window, n_neg), 1)]
    return sorted(out)


def mined(df, every, n_pos, n_neg):
    label = F.col("label")
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, label, n_pos, n_neg).collect()))


@pytest.mark.parametrize("leaf, tree, span", [(4, 40, 2), (64, 4096, 16)])
def test_mining_equals_all_pairs(spark, monkeypatch, leaf, tree, span):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives, "TREE", tree)
    monkeypatch.setattr(negatives, "SPAN", span)
    monkeypatch.setattr(negatives, "TILE", 7)
    rnd = random.Random(3)
    rows = [(i, [round(rnd.uniform(-1, 1), 1) for _ in range(5)], rnd.choice([0, 0, 0, 1, 2])) for i in range(300)]
    rows += [(400, None, 1), (401, [1.0] * 5, None), (402, [None, 1.0], 1), (403, [float("nan")] * 5, 0),
             (404, [float("inf")] * 5, 0), (410, [0.5, 0.25], 1), (420, [], 2), (None, [1.0] * 5, 0), rows[0], rows[10],
             (20, [0.9] * 5, 1)]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], SCHEMA).repartition(3)
    expected = brute(rows, 10, 3, 4)
    assert expected and mined(df, 10, 3, 4) == expected


def test_one_label_no_anchor_and_no_rows(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], 1, "x", 0.0) for i in range(20)], SCHEMA)
    assert mined(df, 5, 3, 4) == []
    assert mined(df.where("vec_id % 5 > 0"), 5, 3, 4) == []
    assert mined(df.limit(0), 5, 3, 4) == []


def test_large_components(spark):
    rows = [(0, [3e5, 1.0], 0), (1, [3e5, 2.0], 0), (2, [2e5, 1.0], 1), (3, [-3e5, 2.0], 1)]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA)
    assert mined(df, 10, 3, 4) == brute(rows, 10, 3, 4)
    far = spark.createDataFrame([(0, [1e13], 0, "x", 0.0), (1, [1e13], 0, "x", 0.0)], SCHEMA)
    with pytest.raises(Exception, match="62 bits"):
        mined(far, 10, 1, 1)


def test_boxes_bound_every_product():
    rng = np.random.default_rng(2)
    matrix, labels = rng.integers(-50, 50, (700, 6)), rng.integers(0, 4, 700)
    order = negatives._tiled(matrix, [2, 4])
    assert sorted(order) == list(range(700))
    matrix, labels = matrix[order], labels[order]
    low, high, least, most = negatives._boxes(matrix, labels)
    n_leaves = -(-700 // negatives.LEAF)
    kids, n = negatives._children(n_leaves)
    assert n == len(low)
    q = rng.integers(-9, 9, (5, 6))
    bottom, top = negatives.intervals(q, low, high)
    scores = q @ matrix.T
    for leaf in range(n_leaves):
        part = scores[:, leaf * negatives.LEAF:(leaf + 1) * negatives.LEAF]
        assert (bottom[:, leaf] <= part.min(axis=1)).all() and (part.max(axis=1) <= top[:, leaf]).all()
    for node, (start, stop) in kids.items():
        assert (low[node] == low[start:stop].min(axis=0)).all() and most[node] == most[start:stop].max()
    assert (low[-1] == matrix.min(axis=0)).all() and (high[-1] == matrix.max(axis=0)).all()
