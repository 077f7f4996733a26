"""Whole flows on small frames with a planted signal, and the registered queries against SQL."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import all_queries
from clickloom.functions import values
from clickloom.operators import columns, metrics, numeric_rule, selection
from clickloom.plans import boosted, features, forest, models, ranking, training
from clickloom.plans.models import Boosting
from clickloom.sources.bundle import load_bundle, save_bundle

AS_OF = datetime(2023, 11, 5)
QUICK = Boosting(rounds=8, depth=3, rate=0.3)
QUICK_TOO = Boosting(rounds=8, depth=2, rate=0.3, seed=43)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(1200):
        id2, id3 = rnd.randrange(1, 41), rnd.randrange(1, 21)
        f1 = rnd.random()
        y = int(rnd.random() < (0.75 if f1 > 0.6 else 0.1))
        at = datetime(2023, 10, 28) + timedelta(hours=rnd.randrange(240))
        rows.append((f"r{i}", id2, id3, at.strftime("%Y-%m-%d %H:%M:%S"), at.date(), y, f1,
                     rnd.choice(["gold", "blue", None])))
    schema = "id1 string, id2 bigint, id3 bigint, id4 string, id5 date, y int, f1 double, f42 string"
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame(
        [(f"t{i}", *r[1:5], r[6], r[7] or "new") for i, r in enumerate(rows[:300])],
        "id1 string, id2 bigint, id3 bigint, id4 string, id5 date, f1 double, f42 string")
    offers = spark.createDataFrame(
        [(k, rnd.choice("abc"), "10/01/2023" if k % 2 else None, "soon" if k == 4 else "12/01/2023",
          None if k == 3 else float(k * 3)) for k in range(1, 16)],
        "id3 bigint, id9 string, id12 string, id13 string, f376 double")
    trans = spark.createDataFrame(
        [(rnd.randrange(1, 31), str(rnd.randrange(100)), AS_OF - timedelta(days=rnd.randrange(90)))
         for _ in range(500)], "id2 bigint, f367 string, f370 timestamp_ntz")
    events = spark.createDataFrame(
        [(rnd.randrange(1, 41), rnd.randrange(1, 21)) for _ in range(2000)], "id2 bigint, id3 bigint")
    return train, test, offers, trans, events


def test_features_keep_the_rows(data):
    train, _, offers, trans, events = data
    got = features.build_features(train, offers, events, trans, AS_OF)
    assert got.count() == 1200
    assert got.where("past_impression_count is null or recency is null or monetary is null").isEmpty()
    assert dict(got.dtypes)["id2"] == "string" and dict(got.dtypes)["past_impression_count"] == "bigint"
    assert got.where("id2 > 30 and frequency > 0").isEmpty()


def test_offer_meta_without_columns(spark, data):
    offers = data[2]
    full = training.offer_meta(offers, AS_OF, ["MM/dd/yyyy"])
    assert full.columns == ["id3", "is_currently_active", "discount_bucket", "id9", "f376"]
    assert full.where("id3 = 4").first()["is_currently_active"] == 1  # unparsable end never closes
    bare = training.offer_meta(offers.select("id3"), AS_OF)
    assert bare.distinct().count() == 15
    assert bare.select("is_currently_active", "discount_bucket").distinct().collect() == [(1, "unk")]


def test_missing_tables_give_constants(data):
    train = data[0]
    df = training.with_transactions(training.with_offer_meta(train, None), None)
    names = ["is_currently_active", "discount_bucket", "trans_cnt", "trans_amt_sum", "trans_amt_mean"]
    assert df.select(*names).distinct().collect() == [(1, "unk", 0, 0.0, 0.0)]
    no_amount = training.with_transactions(train, data[3].drop("f367"))
    assert no_amount.select("trans_cnt").distinct().collect() == [(0,)]


def test_training_table_is_numeric(data):
    train, _, offers, trans, _ = data
    table, rule = training.build_training_table(train, offers, trans, AS_OF, date_formats=["MM/dd/yyyy"])
    assert table.count() == 1200
    feats = training.feature_columns(table, "y")
    assert "id4" in feats and "f42" in rule.encoded  # a time kept as text is a label
    kinds = dict(table.dtypes)
    assert all(kinds[c] in ("bigint", "int", "double") for c in feats)
    assert kinds["id1"] == "string" and kinds["id5"] == "date"
    assert table.where(" or ".join(f"{c} is null" for c in feats)).isEmpty()
    assert table.agg(F.min("f42"), F.max("f42")).first() == (-1, 1)


@pytest.fixture(scope="module")
def fitted(data):
    train, _, offers, trans, _ = data
    return boosted.train(train, offers, trans, AS_OF, date_formats=["MM/dd/yyyy"],
                         first=QUICK, second=QUICK_TOO)


def test_boosted_pair_beats_the_constant_rate(data, fitted):
    bundle, scored = fitted
    assert scored.count() == data[0].where("id5 >= '2023-11-03'").count()
    for c in ("first_score", "second_score", "pred"):
        assert scored.where(f"{c} < 0 or {c} > 1").isEmpty()
    losses = boosted.validation_losses(scored, "y").first()
    rate = scored.agg(F.avg("y")).first()[0]
    flat = metrics.log_losses(scored.withColumn("flat", F.lit(rate)), "y", {"l": "flat"}).first()[0]
    assert max(losses) < flat * 0.9
    blend = scored.where("abs(pred - (0.7 * first_score + 0.3 * second_score)) > 1e-12")
    assert blend.isEmpty()


def test_importances(fitted):
    bundle, _ = fitted
    got = models.importances(bundle.model, bundle.features).orderBy(F.desc("importance")).collect()
    assert len(got) == len(bundle.features) and got[0]["feature"] == "f1"


@pytest.mark.parametrize("shared", [True, False])
def test_score_after_saving(spark, tmp_path, data, fitted, shared):
    _, test, offers, trans, _ = data
    save_bundle(fitted[0], str(tmp_path / "b"))
    bundle = load_bundle(spark, str(tmp_path / "b"))
    args = (test, offers, trans, AS_OF, ["MM/dd/yyyy"], shared)
    a = boosted.score(fitted[0], *args)
    b = boosted.score(bundle, *args)
    assert b.columns == ["id1", "id2", "id3", "id5", "pred"] and b.count() == 300
    assert a.exceptAll(b).isEmpty()
    assert b.where("pred < 0 or pred > 1 or pred is null").isEmpty()
    sub = boosted.submission(bundle, *args)
    assert sub.columns == ["id1", "id2", "id3", "id5", "pred"]
    assert sub.where("id1 like 't%' and id5 rlike '^[0-9]{2}/[0-9]{2}/2023$'").count() == 300


def test_scoring_side_rule(data, fitted):
    _, test, offers, _, _ = data
    df = training.with_offer_meta(test, offers, AS_OF, ["MM/dd/yyyy"])
    got = boosted.serving_rule(df, fitted[0].rule, ["id1"])
    assert dict(got.dtypes)["f42"] == "double"  # a text it does not encode is a number, or 0
    assert got.where("f42 <> 0 or id4 <> 0").isEmpty()
    assert got.where("id9 is null or id9 < 0 or id9 > 2").isEmpty()
    unmatched = got.where("id3 > 15").select("discount_bucket").distinct().collect()
    assert unmatched == [(0,)]  # "missing" is no class of the training rows


def test_missing_features_and_tables_when_scoring(data, fitted):
    _, test, _, _, _ = data
    got = boosted.score(fitted[0], test.drop("f42"), None, None, AS_OF)
    assert got.count() == 300 and got.where("pred is null").isEmpty()


def test_one_booster_is_enough(data):
    train, _, offers, trans, _ = data
    bundle, scored = boosted.train(train.drop("id4"), offers, trans, AS_OF, first=QUICK, second=None,
                                   date_formats=["MM/dd/yyyy"])
    assert "second_score" not in scored.columns
    assert scored.where("pred <> first_score").isEmpty()
    assert len(boosted.validation_losses(scored, "y").columns) == 2


def test_split_without_dates(data):
    train = data[0].drop("id4", "id5")
    _, scored = boosted.train(train, None, None, AS_OF, first=QUICK, second=None)
    assert 150 < scored.count() < 330


def test_rank_submission(data):
    train, test, offers, trans, events = data
    tables = [features.build_features(df, offers, events, trans, AS_OF) for df in (train, test)]
    got = ranking.rank_submission(*tables, settings=QUICK)
    assert got.columns == ["id1", "id2", "id3", "id5", "pred"] and got.count() == 300
    assert got.where("pred < 0 or pred > 1 or pred is null").isEmpty()
    high = got.join(test.select("id1", "f1"), "id1").groupBy((F.col("f1") > 0.6).alias("h"))
    means = dict(high.agg(F.avg("pred")).collect())
    assert means[True] > means[False] + 0.3


def test_forest_submission(data):
    train, test, offers, trans, events = data
    tables = [features.build_features(df, offers, events, trans, AS_OF) for df in (train, test)]
    scored = forest.forest_scores(*tables, trees=10, depth=4)
    assert scored.count() == 300 and scored.where("pred < 0 or pred > 1").isEmpty()
    got = forest.forest_submission(test.select("id2", "id3"), scored)
    assert got.count() == 300 and {r[0] for r in got.select("pred").distinct().collect()} <= {0, 1}


def test_click_rates_leave_the_unknown_empty(spark, data):
    train = data[0].where("id2 <= 20 and id3 <= 10")
    got = features.with_click_rates(data[0], train)
    assert got.count() == 1200
    assert got.where("(id2 > 20) <> (ctr_user is null)").isEmpty()
    assert got.where("(id3 > 10) <> (ctr_offer is null)").isEmpty()


# the registered queries

SMALL = "/root/testdata/sf0.001"


def test_registry():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(all_queries()) == set(ORACLE)  # every query of the library has its SQL


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = connect(SMALL)
    got = registry.queries()[name](spark, SMALL)
    assert differences(got, con, registry.oracle_sql()[name]) == []


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_results_do_not_depend_on_the_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        con = connect(SMALL)
        for name in ("feature_table", "offer_active_flag", "temporal_split", "parse_timestamp"):
            got = registry.queries()[name](spark, SMALL)
            assert differences(got, con, registry.oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() == 1000 and len(df.columns) == 17


def test_no_cross_join_and_no_python(spark):
    for name in ("feature_table", "ctr_encoding", "template_match", "rank_score", "label_encode"):
        plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan and "Arrow" not in plan
        assert "Exchange SinglePartition" not in plan


def test_training_waits_beyond_a_local_bump():
    losses = [0.9, 0.8, 0.85, 0.84, 0.7, 0.75, 0.76, 0.77, 0.6]
    assert models.best_round(losses, 3) == (5, True)
    assert models.best_round(losses, 1) == (2, True)
    assert models.best_round(losses, 10) == (9, False)


def test_noisy_training_keeps_more_than_one_tree(spark):
    """Spark's own stop ends at the first worse round; waiting finds the signal behind the noise."""
    rows = spark.range(1500).select(
        F.col("id").alias("id1"), F.rand(3).alias("f1"), F.rand(4).alias("f2"))
    label = ((F.col("f1") + F.rand(5) * 0.8) > 0.9).cast("int")
    table = models.assembled(rows.withColumn("y", label), ["f1", "f2"], "y", F.col("id1") % 3 == 0)
    fitted = models.fit_pair(table, ["f1", "f2"], models.Boosting(rounds=30, patience=10, depth=2, rate=0.2), None)
    assert fitted.stages[1].getNumTrees > 3


def test_rule_finds_dates_and_flags_by_type(spark):
    df = spark.sql("""select timestamp_ntz '2023-11-04 05:00:00' as id4, date '2023-11-05' as f374,
                      true as flag, cast(null as boolean) as other, 'a' as word, '1.5' as n""")
    rule = numeric_rule.NumericRule().fit(df)
    got = rule.transform(df)
    assert all(t in ("int", "bigint", "double") for _, t in got.dtypes), got.dtypes
    row = got.first()
    assert (row["flag"], row["other"], row["id4_hour"], row["f374_is_weekend"]) == (1, 0, 5, 1)


def test_date_format_is_learnt_or_refused(spark):
    df = spark.createDataFrame([("11/05/2023", "soon"), ("13/05/2023", "later"), ("12/31/2023", None)], "a string, b string")
    assert values.infer_date_format(df, "a") == ["MM/dd/yyyy"]
    with pytest.raises(ValueError, match="no date in column b"):
        values.infer_date_format(df, "b")
    assert values.infer_date_format(df.limit(0), "b") == []


def test_forest_template_rows_get_their_own_score(spark):
    scored = spark.createDataFrame([("r9", 1, 2, 0.9), ("r10", 1, 2, 0.1)], "id1 string, id2 bigint, id3 bigint, pred double")
    got = forest.forest_submission(scored.drop("pred"), scored)
    assert {r["id1"]: r["pred"] for r in got.collect()} == {"r9": 1, "r10": 0}


def test_constant_column_with_nan_is_dropped(spark):
    df = spark.createDataFrame([(3.0,), (float("nan"),), (3.0,)], "f double")
    assert selection.VarianceFilter().fit(df, ["f"]).kept == []
    zero = spark.createDataFrame([(0.0,), (float("nan"),)], "f double")
    assert columns.all_zero(zero, ["f"]).first()["values"] == 1
