import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import topk


def brute(rows, every, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([int(np.floor(256 * x)) for x in v])
    out = {}
    for q in (i for i in vectors if i % every == 0):
        best = {}
        for a in vectors[q]:
            for c, many in vectors.items():
                for b in many:
                    if c != q:
                        best[c] = max(best.get(c, -10**18), sum(x * y for x, y in zip(a, b)))
        out[q] = [(c, s) for c, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return {q: x for q, x in out.items() if x}


@pytest.mark.parametrize("block", [3, 256])
def test_search_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SPAN", 2)
    monkeypatch.setattr(topk, "TILE", 5)
    rnd = random.Random(4)
    rows = [(i, [round(rnd.uniform(-1, 1), 1) for _ in range(4)]) for i in range(120)]  # many ties
    rows += [(200, None), (201, [None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]),
             (204, [0.5, 0.5]), (205, []), (0, rows[0][1]), (None, [1.0] * 4), (10, [0.9, 0.1, 0.0, 0.3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine"))
    got = {}
    for r in topk.search(df, F.col("vec_id") % 10 == 0, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    floats = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute(floats, 10, 3)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    found = topk.search(df, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 256 * 512)]
    assert topk.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, 2.0]), (2, [3e5, 1.0])], "vec_id long, embedding array<double>")
    found = topk.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    big = (256 * 300_000) ** 2
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, big + 256 * 512), (2, big + 256 * 256)]
