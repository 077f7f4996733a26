"""Aggregates, encoders, the numeric rule, selection, splits, ranking, metrics: edge cases."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import aggregates, columns, metrics, ranking, selection, splits
from clickloom.operators.encoders import LabelEncoder
from clickloom.operators.numeric_rule import NumericRule, number_shares

NAN = float("nan")
BUCKETS = ["unk", "zero", "<5", "5-20", "20-50", "50+"]


def as_dict(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


# aggregates

def test_counts_drop_missing_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (None, 1)], "id2 bigint, id3 bigint")
    assert aggregates.impression_counts(df).collect() == [(1, 1, 2)]


def test_rfm(spark):
    rows = [("a", None, datetime(2024, 1, 20)), ("a", 2.5, datetime(2024, 1, 22, 23)),
            ("b", None, datetime(2024, 1, 25, 6)), (None, 1.0, datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "id2 string, f367 double, f370 timestamp_ntz")
    got = as_dict(aggregates.rfm(df, datetime(2024, 1, 24, 1)), "id2",
                  "recency", "frequency", "monetary")
    assert got == {"a": (1, 2, 2.5), "b": (-2, 1, 0.0)}  # a sum of nothing is 0


def test_transaction_features_count_bad_amounts_as_zero(spark):
    df = spark.createDataFrame([(1, "10"), (1, "n/a"), (1, None), (2, "nan")], "id2 bigint, f367 string")
    got = as_dict(aggregates.transaction_features(df), "id2",
                  "trans_cnt", "trans_amt_sum", "trans_amt_mean")
    assert got == {1: (3, 10.0, pytest.approx(10 / 3)), 2: (1, 0.0, 0.0)}


def test_click_rates_and_sizes(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1)], "id2 bigint, y int")
    assert as_dict(aggregates.click_rate(df, "id2", "y", "r"), "id2", "r") == {1: (0.5,), 2: (1.0,)}
    assert as_dict(aggregates.group_sizes(df), "id2", "group_size") == {1: (2,), 2: (1,)}
    assert as_dict(aggregates.target_distribution(df, "y"), "y", "n") == {0: (1,), 1: (3,)}


# columns

def test_choosing_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 1)], "id1 bigint, id9 string, f1 double, y int")
    assert columns.keep_existing(df, ["f1", "nope", "id9"]).columns == ["f1", "id9"]
    assert columns.drop_columns(df, ["y", "nope"], prefix="id").columns == ["f1"]
    assert columns.numeric_only(df).columns == ["id1", "f1", "y"]
    assert columns.align(df, ["f2", "f1"], keep=["id1"], default=0.0).first() == (1, 0.0, 2.0)
    with pytest.raises(ValueError, match="f2"):
        columns.align(df, ["f2"])


def test_target_choice(spark):
    one = spark.createDataFrame([(1, 0)], "y int, clicked int")
    assert columns.target_column(one) == "clicked"
    assert columns.target_column(one.drop("clicked")) == "y"
    with pytest.raises(ValueError, match="no target"):
        columns.target_column(one.select(F.lit(1).alias("x")))


def test_fill_skips_text_and_takes_nan(spark):
    df = spark.createDataFrame([(None, NAN, None)], "i int, d double, s string")
    assert columns.fill(df, 0).first() == (0, 0.0, None)
    assert columns.fill(df, {"s": "x", "i": 5}).first()[0::2] == (5, "x")


def test_all_zero(spark):
    df = spark.createDataFrame([(0, "0.0", None, 1), (0, "0", None, 0)], "a int, b string, c int, d int")
    got = as_dict(columns.all_zero(df, ["a", "b", "c", "d"]), "column", "all_null", "all_zero")
    assert got == {"a": (False, True), "b": (False, True), "c": (True, False), "d": (False, False)}


def test_expand_dates_drops_the_source(spark):
    df = spark.createDataFrame([(1, datetime(2023, 11, 5, 3))], "x int, t timestamp_ntz")
    assert columns.expand_dates(df, ["t"]).columns == [
        "x", "t_hour", "t_day", "t_month", "t_dayofweek", "t_is_weekend"]


# encoders

def test_codes_are_ranks_of_the_text(spark):
    df = spark.createDataFrame([(b,) for b in [*BUCKETS, "unk", None]], "b string")
    model = LabelEncoder(["b"]).fit(df)
    got = dict(df.select(F.col("b").alias("v"), "b").transform(model.transform).distinct().collect())
    assert got == {"20-50": 0, "5-20": 1, "50+": 2, "<5": 3, "unk": 4, "zero": 5, None: -1}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_many_classes_over_many_partitions(spark, limit):
    rnd = random.Random(3)
    values = ["".join(rnd.choices("aäzZ09_é😀", k=rnd.randrange(1, 6))) for _ in range(4000)]
    others = [rnd.choice("xyz") for _ in values]
    df = spark.createDataFrame(list(zip(values, others)), "s string, t string").repartition(7)
    model = LabelEncoder(["s", "t"]).fit(df)
    want = {v: i for i, v in enumerate(sorted(set(values)))}  # code point order
    assert dict(model.table.where("column = 's'").select("value", "code").collect()) == want
    assert dict(model.table.where("column = 't'").select("value", "code").collect()) == {
        "x": 0, "y": 1, "z": 2}
    got = model.transform(df.withColumn("v", F.col("s")), limit=limit).select("v", "s").collect()
    assert len(got) == 4000 and all(want[v] == c for v, c in got)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_many_other_columns_come_through_unchanged(spark, limit):
    """They pass the joins packed; names, order, types and values stay."""
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "y")], "s string, t string").select(
        "s", *[(F.ascii("t") * i).alias(f"c{i}") for i in range(60)], "t", F.lit(None).alias("n"))
    model = LabelEncoder(["s", "t"]).fit(df)
    got = model.transform(df, limit=limit)
    assert got.columns == df.columns
    assert dict(got.dtypes) == {**dict(df.dtypes), "s": "bigint", "t": "bigint"}
    rows = {r["s"]: (r["t"], r["c2"], r["n"]) for r in got.collect()}
    assert rows == {1: (0, 240, None), 0: (-1, None, None), -1: (1, 242, None)}


def test_unseen_policies(spark):
    seen = spark.createDataFrame([("b",), ("c",)], "s string")
    new = spark.createDataFrame([("c",), ("x",), (None,)], "s string").coalesce(1)
    model = LabelEncoder(["s"]).fit(seen)
    codes = lambda **kw: [r[0] for r in model.transform(new, **kw).collect()]
    assert sorted(codes()) == [-1, 0, 1]
    assert sorted(codes(unseen="minus_one")) == [-1, -1, 1]
    with pytest.raises(Exception, match="unseen value in s: x"):
        codes(unseen="error")
    with pytest.raises(ValueError):
        codes(unseen="whatever")


def test_missing_as_a_class(spark):
    a = spark.createDataFrame([("b",), (None,)], "s string")
    b = spark.createDataFrame([("a",), ("z",)], "s string")
    model = LabelEncoder(["s"], filler="nan").fit(a, b)
    got = sorted(r[0] for r in model.transform(a.unionAll(b)).collect())
    assert got == [0, 1, 2, 3]  # a, b, nan, z
    assert dict(model.table.select("value", "code").collect())["nan"] == 2


def test_numbers_can_be_encoded(spark):
    df = spark.createDataFrame([(10,), (9,), (None,)], "i int")
    model = LabelEncoder(["i"]).fit(df)
    assert dict(model.table.select("value", "code").collect()) == {"10": 0, "9": 1}


# the numeric rule

@pytest.fixture(scope="module")
def messy(spark):
    rows = []
    for i in range(100):
        rows.append((
            str(i) if i < 50 else "x",      # exactly half: encoded
            str(i) if i < 51 else None,     # just above half: numeric
            "a" if i % 2 else "b",          # no number at all
            None,                           # nothing at all
            datetime(2023, 11, 5, i % 24),
            NAN if i == 0 else float(i),
        ))
    return spark.createDataFrame(
        rows, "half string, most string, none string, empty string, t timestamp_ntz, d double")


def test_shares(spark, messy):
    got = as_dict(number_shares(messy, ["half", "most", "none", "empty"]), "column",
                  "values", "numbers", "is_numeric")
    assert got == {"half": (100, 50, False), "most": (51, 51, True), "none": (100, 0, False),
                   "empty": (0, 0, False)}


def test_rule_makes_everything_numeric(spark, messy):
    model = NumericRule(dates=["t"]).fit(messy)
    assert (model.numeric, model.encoded, model.empty) == (["most"], ["half", "none"], ["empty"])
    out = model.transform(messy)
    assert columns.text_columns(out) == []
    assert out.where(" or ".join(f"{c} is null or isnan({c})" for c in out.columns)).count() == 0
    assert out.agg(F.sum("most")).first()[0] == sum(range(51))
    assert out.agg(F.min("empty"), F.max("empty")).first() == (-1, -1)
    assert out.agg(F.min("half"), F.max("half")).first() == (0, 50)
    assert "t" not in out.columns and "t_hour" in out.columns


def test_rule_on_an_empty_table(spark, messy):
    model = NumericRule().fit(messy.limit(0))
    assert model.numeric == [] and set(model.empty) == {"half", "most", "none", "empty"}


def test_rule_over_many_columns(spark):
    df = spark.range(5).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(130)])
    model = NumericRule().fit(df)
    assert len(model.numeric) == 130


# selection

def test_variance_is_of_the_population(spark):
    df = spark.createDataFrame([(0.0, 5.0, 0.0, None), (2.0, 5.0, 0.006, None)],
                               "a double, b double, c double, n double")
    got = as_dict(selection.variances(df, ["a", "b", "c", "n"]), "feature", "variance", "kept")
    assert got["a"] == (1.0, True) and got["b"] == (0.0, False)
    assert got["c"][1] is False and got["n"] == (None, False)  # 9e-6 is too little
    model = selection.VarianceFilter().fit(df, ["a", "b", "c", "n"])
    assert model.kept == ["a"] and model.transform(df, keep=["n"]).columns == ["n", "a"]


def test_variance_at_the_threshold_is_dropped(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "a double")
    assert selection.VarianceFilter(threshold=1.0).fit(df, ["a"]).kept == []


def test_variances_over_many_columns(spark):
    df = spark.range(4).select(*[(F.col("id") * (i % 2)).alias(f"c{i}") for i in range(130)])
    assert len(selection.VarianceFilter().fit(df, df.columns).kept) == 65


# splits

def test_missing_date_is_in_neither_part(spark):
    days = [date(2023, 11, 2), date(2023, 11, 3), date(2023, 11, 4), None]
    df = spark.createDataFrame([(d,) for d in days], "id5 date")
    a, b = splits.time_split(df, "id5", datetime(2023, 11, 3))
    assert a.collect() == [(days[0],)] and sorted(b.collect()) == [(days[1],), (days[2],)]


def test_random_split_is_a_partition(spark):
    df = spark.range(4000).withColumnRenamed("id", "id1")
    a, b = splits.random_split(df)
    assert a.count() + b.count() == 4000 and a.intersect(b).isEmpty()
    assert 700 < b.count() < 900
    assert splits.random_split(df.repartition(5))[1].exceptAll(b).isEmpty()
    assert not splits.random_split(df, seed=7)[1].exceptAll(b).isEmpty()


def test_folds_share_no_customer(spark):
    df = splits.with_group_fold(spark.range(2000).select((F.col("id") % 97).alias("id2")))
    assert df.groupBy("id2").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()


def test_sort_for_output(spark):
    df = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 1),)], "id5 date")
    assert [r[0].day for r in splits.sorted_by_date(df).collect()] == [1, 2]


# ranking and metrics

@pytest.fixture(scope="module")
def scored_rows():
    rnd = random.Random(5)
    rows = [(i, 1 if rnd.random() < 0.35 else rnd.randrange(2, 40), rnd.randrange(5),
             float(rnd.randrange(50)) / 10 - 2, int(rnd.random() < 0.2)) for i in range(2000)]
    rows += [(5000, 99, 1, 3.0, 0), (5001, 98, 1, 2.0, 1), (5002, 98, 2, 2.0, 0), (5003, None, 1, 1.0, 1)]
    return rows


@pytest.fixture(scope="module")
def scored(spark, scored_rows):
    return spark.createDataFrame(scored_rows, "id1 bigint, id2 bigint, id3 bigint, pred double, y int")


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_rank_score(scored, scored_rows, hot_rows):
    groups = defaultdict(list)
    for _, id2, _, pred, _ in scored_rows:
        groups[id2].append(pred)
    got = as_dict(ranking.with_rank_score(scored, hot_rows=hot_rows), "id1", "rank_score")
    assert len(got) == len(scored_rows)
    for id1, id2, _, pred, _ in scored_rows:
        if id2 is None:
            assert got[id1] == (None,)
        else:
            low, high = min(groups[id2]), max(groups[id2])
            assert got[id1][0] == pytest.approx((pred - low) / (high - low + 1e-9))
            assert 0 <= got[id1][0] <= 1
    assert got[5000] == (0.0,) and got[5001] == (0.0,)  # single row, constant group


def test_last_per_key(spark, scored, scored_rows):
    last = {}
    for id1, id2, id3, pred, _ in sorted(scored_rows):
        last[(id2, id3)] = (id1, pred)
    for cols in (["pred"], ["id1", "pred"]):
        got = ranking.last_per_key(scored, ["id2", "id3"], "id1", cols).collect()
        assert {(r["id2"], r["id3"]): r["pred"] for r in got} == {k: v[1] for k, v in last.items()}
    # the last row wins even if it holds nothing
    df = spark.createDataFrame([(1, 1, 0.5), (2, 1, None)], "pos int, k int, pred double")
    for cols in (["pred"], ["pos", "pred"]):
        assert ranking.last_per_key(df, ["k"], "pos", cols).first()["pred"] is None


def test_top(scored):
    got = ranking.top(scored, "pred", 3, "id1").collect()
    best = sorted(scored.collect(), key=lambda r: (-r["pred"], r["id1"]))[:3]
    assert [r["id1"] for r in got] == [r["id1"] for r in best]


def brute_map(rows, k):
    groups = defaultdict(list)
    for id1, id2, _, pred, y in rows:
        groups[id2].append((-pred, id1, y))
    total = []
    for group in groups.values():
        clicks = sum(y for *_, y in group)
        if not clicks:
            continue
        hits = score = 0
        for rank, (_, _, y) in enumerate(sorted(group)[:k], 1):
            hits += y
            score += y * hits / rank
        total.append(score / min(clicks, k))
    return len(total), sum(total) / len(total)


@pytest.mark.parametrize("k", [1, 5, 100])
def test_map_at_k(scored, scored_rows, k):
    known = [r for r in scored_rows if r[1] is not None]
    n, value = metrics.map_at_k(scored.where("id2 is not null"), k).first()
    want_n, want = brute_map(known, k)
    assert n == want_n and value == pytest.approx(want)


def test_map_limits_rows_before_the_shuffle(scored):
    plan = metrics.average_precision(scored)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_small_tables(spark, scored):
    assert metrics.prediction_range(scored).first() == (2004, -2.0, 3.0)
    parts = {"a": scored.where("y = 1"), "b": scored.where("y = 0").limit(0)}
    got = as_dict(metrics.split_summary(parts, "y"), "part", "n", "target_rate")
    assert got["a"][1] == 1.0 and got["b"] == (0, None)
    df = spark.createDataFrame([(1, 0.5, 0.25), (0, 0.5, 0.75)], "y int, p double, q double")
    a, b = metrics.log_losses(df, "y", {"a": "p", "b": "q"}).first()
    assert a == pytest.approx(0.693147, abs=1e-6) and b == pytest.approx(1.386294, abs=1e-6)
