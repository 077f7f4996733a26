"""Exact shares, balanced folds, counts before a time, and rows by position, against plain loops."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators import aggregates, splits, submission
from clickloom.sources.tables import infer_types, read_csv, read_parquet


@pytest.mark.parametrize("n, share", [(997, 0.2), (10, 0.25), (3, 0.5), (1, 0.2), (0, 0.2)])
def test_exact_share(spark, n, share):
    df = spark.range(n).select(F.col("id").alias("id1"), (F.col("id") % 7).alias("v")).repartition(3)
    train, test = splits.exact_split(df, "id1", share)
    assert test.count() == math.ceil(share * n) and train.count() == n - math.ceil(share * n)
    assert train.unionAll(test).exceptAll(df).isEmpty()
    again = splits.exact_split(df.repartition(5), "id1", share)[1]
    assert again.exceptAll(test).isEmpty()


def test_exact_share_of_one_repeated_or_missing_key(spark):
    df = spark.range(100).select(F.when(F.col("id") < 50, "k").alias("id1"), F.col("id").alias("v"))
    train, test = splits.exact_split(df, "id1", 0.3)
    assert (train.count(), test.count()) == (70, 30)


def folds_by_loop(sizes, folds, large):
    total = sum(sizes.values())
    loads, out = [0] * folds, {}
    order = sorted(sizes, key=lambda k: (-sizes[k], k))
    for k in [k for k in order if sizes[k] * folds * large >= total]:
        out[k] = loads.index(min(loads))
        loads[out[k]] += sizes[k]
    level = max(loads)
    for i in range(1, folds + 1):
        low = sorted(loads)[:i]
        filled = (sum(low) + total - sum(loads)) / i
        if i == folds or filled <= sorted(loads)[i]:
            level = filled
            break
    ends = [sum(max(level - x, 0) for x in loads[:f + 1]) for f in range(folds)]
    at = 0
    for k in [k for k in order if k not in out]:
        out[k] = sum(at >= e - 1e-9 for e in ends[:-1])
        at += sizes[k]
    return out


@pytest.mark.parametrize("hot", [1, 3000])
def test_balanced_folds(spark, hot):
    rnd = random.Random(hot)
    sizes = {k: rnd.randrange(1, 30) for k in range(150)} | {500: hot, 501: hot // 2 + 1}
    rows = [(k,) for k, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows + [(None,)], "id2 long").repartition(5)
    got = splits.with_balanced_fold(df, hot_rows=200)
    assert got.count() == len(rows) + 1 and got.where("id2 is null and fold is not null").isEmpty()
    found = {r["id2"]: r["fold"] for r in got.dropna().distinct().collect()}
    assert found == folds_by_loop(sizes, 5, splits.LARGE)
    assert got.dropna().distinct().count() == len(sizes)
    if hot == 1:
        loads = [r["count"] for r in got.dropna().groupBy("fold").count().collect()]
        assert max(loads) - min(loads) <= 2 * 30


def test_bounds_fill_to_one_level():
    assert splits.fold_bounds([0, 0], 10) == [5, 10]
    assert splits.fold_bounds([8, 0, 2], 4) == [0, 3, 4]
    assert splits.fold_bounds([0, 0, 0], 0) == [0, 0, 0]


def test_counts_before(spark):
    rnd = random.Random(8)
    t0 = datetime(2024, 1, 1)
    pick = lambda n: (rnd.choice([1, 1, 1, 2, None]), rnd.choice([7, 7, 8, None]), rnd.choice([None, t0, *[
        t0 + timedelta(hours=rnd.randrange(20)) for _ in range(8)]]))
    shows = [(f"r{i}", *pick(i)) for i in range(300)]
    events = [pick(i) for i in range(400)]
    got = aggregates.impression_counts_before(
        spark.createDataFrame(shows, "id1 string, id2 long, id3 long, id4 timestamp_ntz").repartition(4),
        spark.createDataFrame(events, "id2 long, id3 long, ts timestamp_ntz").repartition(3))
    expected = {r: sum(1 for e in events if e[0] == a and e[1] == b and e[2] is not None and e[2] < t)
                for r, a, b, t in shows if None not in (a, b, t)}
    assert {r["id1"]: r["past_impression_count"] for r in got.collect()} == expected


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_rows_meet_by_position(spark, tmp_path, kind, monkeypatch):
    n = 500
    rows = spark.range(n).select(F.lit(1).alias("id2"), F.lit(2).alias("id3"), F.col("id").alias("tag"))
    scores = spark.range(n - 20).select((F.col("id") * 0.5).alias("pred"))
    read = {"csv": read_csv, "parquet": read_parquet}[kind]
    tables = []
    for name, df, parts in (("template", rows, 3), ("predictions", scores, 7)):
        first = df.columns[-1]
        df = df.repartitionByRange(parts, first).sortWithinPartitions(first)
        writer = df.write.option("header", True)
        getattr(writer, kind)(str(tmp_path / name))
        tables.append(read(spark, str(tmp_path / name), position="_position"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")  # several blocks per file
    try:
        got = submission.match_by_position(*tables)
        assert got.columns == ["id2", "id3", "tag", "pred", "matched"] and got.count() == n
        assert got.where("matched <> (tag < 480) or pred <> if(tag < 480, tag * 0.5, 0)").isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_types_are_learnt_in_one_scan(spark):
    n = 60
    raw = spark.range(20).select(*[
        F.when(F.col("id") % 5 > 0, {0: F.col("id").cast("string"), 1: (F.col("id") / 4).cast("string"),
                                     2: F.when(F.col("id") % 2 == 0, "true").otherwise("False"),
                                     3: F.lit("x1")}[i % 4]).alias(f"c{i}") for i in range(n)], F.lit(None).cast("string").alias("none"))
    kinds = [f.dataType.simpleString() for f in infer_types(raw).fields]
    assert kinds == ["bigint", "double", "boolean", "string"] * (n // 4) + ["double"]
    assert infer_types(raw.select()).fields == []
    mixed = spark.createDataFrame([("1", "1"), ("99999999999999999999", "true")], "a string, b string")
    assert [f.dataType.simpleString() for f in infer_types(mixed).fields] == ["double", "string"]


def test_declared_types_are_not_learnt(spark, tmp_path):
    spark.createDataFrame([("1", "2"), ("3", "4")], "a string, b string").write.option("header", True).csv(str(tmp_path / "t"))
    from pyspark.sql import types as T

    got = read_csv(spark, str(tmp_path / "t"), declared=T.StructType().add("a", T.StringType()).add("zz", T.LongType()))
    assert got.dtypes == [("a", "string"), ("b", "bigint")]


def test_places_by_date(spark):
    df = spark.createDataFrame([(3, "b"), (1, "b"), (2, None), (4, "a")], "id1 long, id5 string")
    assert {r["id1"]: r["position"] for r in splits.numbered_by_date(df).collect()} == {2: 1, 4: 2, 1: 3, 3: 4}
