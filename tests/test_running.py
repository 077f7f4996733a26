import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.running import running


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_equal_a_loop(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 1, 2, 3]), rnd.choice("ab"), i, rnd.choice([None, 5, -3, 2**40]),
             rnd.randrange(-2**63, 2**63)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, s string, t long, v long, x long").repartition(7)
    got = running(df, ["k", "s"], ["t"], {"total": F.col("v")}, {"mix": F.col("x")}).collect()
    sums, mixes, expected = {}, {}, set()
    for k, s, t, v, x in sorted(rows, key=lambda r: r[2]):
        sums[k, s] = sums.get((k, s), 0) + (v or 0)
        mixes[k, s] = mixes.get((k, s), 0) ^ x
        expected.add((k, s, t, sums[k, s], mixes[k, s]))
    assert {(r["k"], r["s"], r["t"], r["total"], r["mix"]) for r in got} == expected and len(got) == 500


def test_one_group_runs_through_all_pieces(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id").repartition(5)
    got = running(df, ["k"], ["id"], {"n": F.lit(1)})
    assert got.where(F.col("n") != F.col("id") + 1).isEmpty() and got.count() == 1000


def test_no_rows(spark):
    df = spark.createDataFrame([], "k long, t long")
    assert running(df, ["k"], ["t"], {"n": F.lit(1)}).collect() == []
