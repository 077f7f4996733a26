"""One query per operator: the library applied to the whole of the driver's tables."""

from __future__ import annotations

import uuid
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.boosting import fit as boosting
from clickloom.boosting.objectives import LISTWISE
from clickloom.functions.calendar import calendar_parts
from clickloom.functions.offers import active_flag, discount_bucket as bucket_of
from clickloom.functions.scores import blend, hard_label
from clickloom.functions.values import infer_date_format as infer_format
from clickloom.functions.values import number, parse_timestamp as parse, strict_timestamp as strictly, wall_clock
from clickloom.operators import aggregates, columns, joins, metrics, ranking, selection, splits
from clickloom.operators.encoders import LabelEncoder
from clickloom.operators.numeric_rule import NumericRule, number_shares
from clickloom.operators.submission import format_submission, match_by_position, match_template
from clickloom.plans import boosted, features, forest, models, ranking as rank_plan, training
from clickloom.session import shared_folder, written
from clickloom.sources import schemas
from clickloom.sources.bundle import load_bundle, save_bundle
from clickloom.sources.tables import read_csv, read_dictionary, read_parquet, with_comments, write_csv

from . import views
from .views import AS_OF


# sources and projections

def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/events.parquet", views.SCHEMAS["events"])


def scan_tables(spark, sf):
    """Rows, values and range of the first two columns of the five tables that stand for the inputs."""
    parts = []
    for name in ("events", "orders", "part", "customer", "lineitem"):
        df = read_parquet(spark, f"{sf}/{name}.parquet")
        key, second = df.columns[:2]
        parts.append(df.agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.count(second).alias("second_values"),
            F.min(key).cast("bigint").alias("low"), F.max(key).cast("bigint").alias("high")))
    return reduce(DataFrame.unionAll, parts)


def _day_as_text(df):
    return df.withColumn("id5", F.col("id5").cast("string"))


def missing_meta_defaults(spark, sf):
    df = training.with_offer_meta(views.impressions(spark, sf), None)
    return _day_as_text(training.with_transactions(df, None))


def normalize_keys(spark, sf):
    return features.normalize_keys(views.impressions(spark, sf)).select("id1", "id2", "id3")


def coerce_numeric(spark, sf):
    trans = views.trans_all(spark, sf)
    return trans.select("id2", "f367", number(trans, "f367", 0.0).alias("amount"))


def parse_timestamp(spark, sf):
    at = parse(F.col("id4"), ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy"))
    return views.dated_text(spark, sf).select("id1", "id4", at.alias("parsed"))


def calendar_features(spark, sf):
    return views.impressions(spark, sf).select("id1", *calendar_parts(F.col("id4"), "id4"))


def offer_active_flag(spark, sf):
    flag = active_flag(F.col("id12"), F.col("id13"), wall_clock(AS_OF))
    return views.offers_all(spark, sf).select("id3", "id12", "id13", flag.alias("is_currently_active"))


def discount_bucket(spark, sf):
    offers = views.offers_all(spark, sf)
    return offers.select("id3", "f376", bucket_of(number(offers, "f376")).alias("discount_bucket"))


def offer_meta_prep(spark, sf):
    return training.offer_meta(views.offers_all(spark, sf), AS_OF)


def feature_projection(spark, sf):
    df = training.with_offer_meta(views.impressions(spark, sf), views.offers(spark, sf), AS_OF)
    df = columns.drop_columns(df, ["y", "not_there"], prefix="id")
    return columns.fill(columns.numeric_only(df), 0)


def align_features(spark, sf):
    train_features = ["past_impression_count", "f1", "f2"]
    return columns.align(views.impressions(spark, sf).drop("y"), train_features, keep=["id1"], default=0.0)


def fill_nulls(spark, sf):
    df = columns.fill(views.offers_all(spark, sf).select("id3", "id10", "f376", "id13"), {"f376": -1.0})
    rows = views.offers_all(spark, sf).select("id3", F.col("f376").alias("all_filled"), "id11")
    return df.join(columns.fill(rows, 0), "id3", "left")


def infer_numeric_columns(spark, sf):
    parts = [
        number_shares(views.trans_all(spark, sf), ["f367"]),
        number_shares(views.offers_all(spark, sf), ["id9", "id10", "id11"]),
        number_shares(views.dated_text(spark, sf), ["id4"]),
    ]
    shares = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return shares.withColumn("share", F.round("share", 6))


def column_all_zero(spark, sf):
    df = training.with_transactions(views.impressions(spark, sf), None)
    return columns.all_zero(df, ["id1", "f1", "y", "trans_cnt"])


# joins and aggregates

def join_offer_meta(spark, sf):
    df = training.with_offer_meta(views.impressions(spark, sf), views.offers(spark, sf), AS_OF)
    return _day_as_text(columns.fill(df, {"is_currently_active": 0}))


def past_impressions(spark, sf):
    counts = aggregates.impression_counts(views.history(spark, sf))
    lookup = features.Lookup(counts, ["id2", "id3"], features.COUNT_FILL)
    return features.attach(views.impressions(spark, sf), [lookup]).select(
        "id1", "id2", "id3", "past_impression_count"
    )


def past_impressions_before(spark, sf):
    """Only events before an impression's own time count."""
    rows = views.impressions(spark, sf)
    events = views.table(spark, sf, "events").where(F.col("event_type").isin("view", "click")).select(
        F.col("user_id").alias("id2"), F.get_json_object("props", "$.k").cast("bigint").alias("id3"), "ts")
    counts = aggregates.impression_counts_before(rows, events)
    return features.attach(rows, [features.Lookup(counts, ["id1"], features.COUNT_FILL)]).select(
        "id1", "id2", "id3", "past_impression_count")


def rfm_features(spark, sf):
    lookup = features.Lookup(
        aggregates.rfm(views.trans(spark, sf), AS_OF), ["id2"], features.RFM_FILL
    )
    df = features.attach(views.impressions(spark, sf), [lookup])
    return df.select("id1", "id2", "recency", "frequency", F.round("monetary", 2).alias("monetary"))


def trans_features(spark, sf):
    df = training.with_transactions(views.impressions(spark, sf), views.trans(spark, sf))
    return df.select("id1", "id2", *_rounded_spending())


def ctr_by_offer(spark, sf):
    rates = aggregates.click_rate(views.train(spark, sf), "id3", "y", "ctr_offer")
    return rates.select("id3", F.round("ctr_offer", 9).alias("ctr_offer"))


def ctr_by_user(spark, sf):
    rates = aggregates.click_rate(views.train(spark, sf), "id2", "y", "ctr_user")
    return rates.select("id2", F.round("ctr_user", 9).alias("ctr_user"))


def ctr_encoding(spark, sf):
    train = views.train(spark, sf)
    parts = [
        features.with_click_rates(df, train).select("id1", "ctr_offer", "ctr_user")
        for df in (train, views.test(spark, sf))
    ]
    both = parts[0].unionByName(parts[1])
    return both.select("id1", *[F.round(c, 9).alias(c) for c in ("ctr_offer", "ctr_user")])


def group_sizes(spark, sf):
    return aggregates.group_sizes(views.impressions(spark, sf))


def variance_filter(spark, sf):
    df = training.with_offer_meta(views.impressions(spark, sf), views.offers(spark, sf), AS_OF)
    df = columns.with_defaults(df, {"constant": 1.0})
    names = ["f1", "y", "is_currently_active", "f376", "constant"]
    return selection.variances(df, names).withColumn("variance", F.round("variance", 6))


def target_distribution(spark, sf):
    return aggregates.target_distribution(views.impressions(spark, sf), "y")


# encoders and splits

def _with_meta(spark, sf, rows):
    return training.with_offer_meta(rows, views.offers(spark, sf), AS_OF)


def label_encode(spark, sf):
    names = ["discount_bucket", "id9", "id10", "id11"]
    df = _with_meta(spark, sf, views.train(spark, sf)).select("id1", *names)
    return LabelEncoder(names).fit(df).transform(df)


def joint_label_encode(spark, sf):
    names = ["id9", "id10"]
    train, test = (
        _with_meta(spark, sf, rows).select("id1", *names)
        for rows in (views.train(spark, sf), views.test(spark, sf))
    )
    coded = rank_plan.encode_jointly(train, test, names)
    return coded[0].unionByName(coded[1])


def encode_unseen(spark, sf):
    """Classes of the training rows, applied to the test rows: most pairs were never seen."""
    def texts(rows):
        pair = F.concat_ws("_", "id2", "id3")
        return _with_meta(spark, sf, rows).select("id1", pair.alias("pair"), "id11")

    encoder = LabelEncoder(["pair", "id11"], filler=boosted.SERVED_FILLER).fit(
        texts(views.train(spark, sf))
    )
    return encoder.transform(texts(views.test(spark, sf)), unseen="first")


def group_fold(spark, sf):
    return splits.with_group_fold(views.impressions(spark, sf)).select("id1", "id2", "fold")


def balanced_folds(spark, sf):
    return splits.with_balanced_fold(views.impressions(spark, sf)).select("id1", "id2", "fold")


def balanced_folds_large(spark, sf):
    """Seven groups, all large: the largest first, each into the emptiest of three folds."""
    rows = views.impressions(spark, sf).select("id1", (F.col("id2") * F.col("id2") % 7).alias("group"))
    return splits.with_balanced_fold(rows, "group", 3)


def exact_split(spark, sf):
    train, test = splits.exact_split(views.impressions(spark, sf), "id1", 0.2, 42)
    return _labelled({"train": train, "valid": test})


def temporal_split(spark, sf):
    before, after = splits.time_split(views.impressions(spark, sf), "id5", AS_OF.date())
    return _labelled({"train": before, "valid": after})


def random_split(spark, sf):
    train, test = splits.random_split(views.impressions(spark, sf), "id1", 0.2, 42)
    return _labelled({"train": train, "valid": test})


def split_summary(spark, sf):
    before, after = splits.time_split(views.impressions(spark, sf), "id5", AS_OF.date())
    summary = metrics.split_summary({"train": before, "valid": after}, "y")
    return summary.withColumn("target_rate", F.round("target_rate", 9))


def _labelled(parts):
    labelled = [df.select("id1", F.lit(name).alias("part")) for name, df in parts.items()]
    return labelled[0].unionAll(labelled[1])


# scores and submissions

def _scored(spark, sf):
    df = views.scored(spark, sf)
    return df.withColumn("pred", blend(F.col("first_score"), F.col("second_score")))


def blend_scores(spark, sf):
    return _scored(spark, sf).select("id1", F.round("pred", 9).alias("pred"))


def hard_labels(spark, sf):
    return views.scored(spark, sf).select("id1", hard_label(F.col("first_score")).alias("pred"))


def log_loss(spark, sf):
    losses = metrics.log_losses(
        _scored(spark, sf), "y",
        {"first_loss": "first_score", "second_loss": "second_score", "blend_loss": "pred"},
    )
    return losses.select(*[F.round(c, 6).alias(c) for c in losses.columns])


def prediction_range(spark, sf):
    return metrics.prediction_range(views.scored(spark, sf), "first_score")


def rank_score(spark, sf):
    df = ranking.with_rank_score(views.scored(spark, sf), score="first_score")
    return df.select("id1", "id2", F.round("rank_score", 6).alias("rank_score"))


def dedupe_last(spark, sf):
    return ranking.last_per_key(
        views.scored(spark, sf), ["id2", "id3"], "id1", ["id1", "first_score"]
    )


def _matched(spark, sf):
    """Test rows as the template, training rows as the predictions, which repeat keys."""
    known = views.scored(spark, sf).where(F.col("id5") < wall_clock(AS_OF.date()))
    predictions = known.select("id1", "id2", "id3", F.col("first_score").alias("pred"))
    return match_template(views.test(spark, sf).select("id1", "id2", "id3"), predictions, "id1")


def template_match(spark, sf):
    return _matched(spark, sf)


def match_summary(spark, sf):
    return metrics.match_summary(_matched(spark, sf))


def submission_ids(spark, sf):
    rows = views.scored(spark, sf).withColumnRenamed("first_score", "pred")
    kept = format_submission(rows, keep={"id1", "id5"}).withColumn("source", F.lit("kept"))
    rebuilt = format_submission(rows, keep=set()).withColumn("source", F.lit("rebuilt"))
    return kept.unionByName(rebuilt)


def map_at_5(spark, sf):
    result = metrics.map_at_k(views.scored(spark, sf), 5, score="first_score")
    return result.withColumn("map_at_5", F.round("map_at_5", 6))


# whole flows

def feature_table(spark, sf):
    df = features.build_features(
        views.impressions(spark, sf), views.offers(spark, sf), views.history(spark, sf),
        views.trans(spark, sf), AS_OF,
    )
    return _day_as_text(df).withColumn("monetary", F.round("monetary", 2))


def training_table(spark, sf):
    table, _ = training.build_training_table(
        views.train(spark, sf), views.offers(spark, sf), views.trans(spark, sf), AS_OF,
        dates=["id4"],
    )
    return _day_as_text(table).withColumns({
        "trans_amt_sum": F.round("trans_amt_sum", 2), "trans_amt_mean": F.round("trans_amt_mean", 4),
    })


def _rounded_spending():
    return [
        "trans_cnt",
        F.round("trans_amt_sum", 2).alias("trans_amt_sum"),
        F.round("trans_amt_mean", 4).alias("trans_amt_mean"),
    ]


@lru_cache(maxsize=4)
def _bundle(spark, sf):
    """The fitted boosters at the library's own settings; fitted once for the queries that use them."""
    bundle, rows = boosted.train(
        views.impressions(spark, sf), views.offers(spark, sf), views.trans(spark, sf), AS_OF, AS_OF)
    return bundle, written(rows, "scored")


def _tree_rows(spark, sf):
    """Whole-numbered features: few values each, so that bins are values."""
    rows = views.impressions(spark, sf).select(
        "id1", "id2", "y", (F.col("id2") % 11).alias("a"), (F.col("id3") % 13).alias("b"), F.hour("id4").alias("c"))
    return models.assembled(rows, ["a", "b", "c"], "y", keep=["id1", "id2"])


def _one_tree(spark, sf, objective, lists=None):
    settings = boosting.Boosting(
        rounds=1, leaves=3, rate=1.0, l2=1.0, feature_share=1.0, row_share=1.0, objective=objective)
    rows = _tree_rows(spark, sf)
    (model,) = boosting.fit(rows, [settings], ["tree"], lists=lists)
    return model, rows


def booster_tree(spark, sf):
    """Scores after one round: two splits, the better leaf first, and their leaves' weights."""
    model, rows = _one_tree(spark, sf, "logistic")
    return model.transform(rows).select("id1", F.round("tree_raw", 5).alias("score"))


def booster_gains(spark, sf):
    """Gain and splits of every feature, from the nodes of that tree."""
    model, _ = _one_tree(spark, sf, "logistic")
    return model.gains(["a", "b", "c"]).select("feature", F.round("gain", 3).alias("gain"), "splits")


def ranker_tree(spark, sf):
    """Scores after one round of the listwise loss, with the offers of a customer as a list."""
    model, rows = _one_tree(spark, sf, LISTWISE, F.col("id2"))
    return model.transform(rows).select("id1", F.round("tree_score", 6).alias("score"))


def _is_share(name):
    return F.col(name).between(0, 1)


def gbt_scores(spark, sf):
    """Held-out rows with one score each. What scores must satisfy is a column; their values are not."""
    _, scored = _bundle(spark, sf)
    return scored.select("id1", "id2", "id3", "y", _is_share("first_score").alias("in_range"))


def ensemble_scores(spark, sf):
    _, scored = _bundle(spark, sf)
    blend_error = F.abs(F.col("pred") - (0.7 * F.col("first_score") + 0.3 * F.col("second_score")))
    return scored.select(
        "id1", "id2", "id3", "y", _is_share("first_score").alias("first_in_range"),
        _is_share("second_score").alias("second_in_range"), (blend_error < 1e-9).alias("is_blend"))


def top_importance(spark, sf):
    """Rank and order of the importances; all of them add up to one."""
    bundle, _ = _bundle(spark, sf)
    every = models.importances(bundle.model, bundle.features)
    top = ranking.top(every, "importance", 20, "feature")
    order = Window.orderBy(F.desc("importance"), "feature")  # twenty rows
    total = every.agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("adds_up"))
    return top.select(
        F.row_number().over(order).alias("rank"),
        F.coalesce(F.col("importance") <= F.lag("importance").over(order), F.lit(True)).alias("falls"),
    ).crossJoin(F.broadcast(total))


def submission(spark, sf):
    bundle, _ = _bundle(spark, sf)
    made = boosted.submission(
        bundle, views.test(spark, sf), views.offers(spark, sf), views.trans(spark, sf), AS_OF
    )
    return made.select("id1", "id2", "id3", "id5", _is_share("pred").alias("in_range"))


def _feature_tables(spark, sf):
    """Train and test features, stored as the models' flows expect them."""
    return [
        written(features.build_features(
            rows, views.offers(spark, sf), views.history(spark, sf), views.trans(spark, sf), AS_OF
        ), "features")
        for rows in (views.train(spark, sf), views.test(spark, sf))
    ]


def rf_scores(spark, sf):
    """Every row of the template once, with a label of its own score."""
    train, test = _feature_tables(spark, sf)
    scored = written(forest.forest_scores(train, test), "forest-scores")
    template = views.test(spark, sf).select("id1", "id2", "id3")
    labels = forest.forest_submission(template, scored)
    own = scored.select(F.col("id1").cast("string").alias("id1"), F.col("pred").alias("score"))
    return labels.join(own, "id1").select(
        F.col("id1").cast("bigint").alias("id1"), "id2", "id3", _is_share("score").alias("in_range"),
        (F.col("pred") == (F.col("score") > 0.5).cast("int")).alias("is_label"))


def ranker_scores(spark, sf):
    """Scaled scores of every test row; the best of a customer is 1 unless all are equal."""
    train, test = _feature_tables(spark, sf)
    ranked = rank_plan.rank_submission(train, test)
    best = Window.partitionBy("id2")
    top, low = F.max("pred").over(best), F.min("pred").over(best)
    return ranked.select(
        "id1", F.col("id2").cast("bigint").alias("id2"), "id3", _is_share("pred").alias("in_range"),
        ((low == 0) & ((F.abs(top - 1) < 1e-3) | (top == 0))).alias("is_scaled"))


# further checks on whole tables

def join_collisions(spark, sf):
    """Impressions with an ``f376`` of their own, offers with theirs, and spending."""
    rows = views.impressions(spark, sf).select("id1", "id2", "id3", F.col("f1").alias("f376"))
    offers = views.offers(spark, sf).select("id3", "f376", F.col("id9").alias("trans_cnt"))
    spending = aggregates.transaction_features(views.trans(spark, sf)).select("id2", "trans_cnt")
    return joins.attach(rows, [
        joins.Lookup(offers, ["id3"], {"f376": -5.0, "trans_cnt": "none"}, dimension=True),
        joins.Lookup(spending, ["id2"], {"trans_cnt": 0}),
    ])


def variance_with_nan(spark, sf):
    nan = F.when(F.col("id1") % 7 == 0, F.lit(float("nan")))
    df = views.impressions(spark, sf).select(
        F.coalesce(nan, F.col("f1")).alias("f1"), F.coalesce(nan, F.lit(3.0)).alias("constant"))
    return selection.variances(df, df.columns).withColumn("variance", F.round("variance", 6))


def numeric_rule_types(spark, sf):
    """Dates, flags, numbers in text and plain text, found by their types alone."""
    df = views.impressions(spark, sf).select(
        "id1", "id4", (F.col("f1") > 20).alias("flag"), F.col("f1").cast("string").alias("f1"),
        F.when(F.col("y") == 1, "clicked").otherwise("not").alias("word"))
    out = NumericRule().fit(df.drop("id1")).transform(df, skip=["id1"])
    return out.withColumn("f1", F.round("f1", 6))


def infer_date_format(spark, sf):
    us = F.date_format("id4", "MM/dd/yyyy")
    text = F.when(F.col("id1") % 5 == 0, F.date_format("id4", "yyyy-MM-dd")).otherwise(us)
    df = views.impressions(spark, sf).select("id1", text.alias("id5"))
    formats = infer_format(df, "id5")
    return df.select("id1", parse(F.col("id5"), formats).alias("parsed"))


def template_by_row(spark, sf):
    scored = views.scored(spark, sf).select("id1", "id2", "id3", F.col("first_score").alias("pred"))
    made = forest.forest_submission(views.test(spark, sf).select("id1", "id2", "id3"), scored)
    return made.withColumn("id1", F.col("id1").cast("bigint"))


def _stored(spark, df, write):
    path = f"{shared_folder(spark)}/clickloom/check-{uuid.uuid4().hex}"
    write(df, path)
    return path


def csv_round_trip(spark, sf):
    df = views.impressions(spark, sf).select("id1", "id2", "id3", "id4", "f1", "y")
    return read_csv(spark, _stored(spark, df, write_csv), schema=df.schema)


def dictionary_comments(spark, sf):
    """Part names as a dictionary of descriptions, attached to a table's columns and read from there."""
    rows = views.table(spark, sf, "part").select(
        F.concat(F.lit("f"), F.col("p_partkey")).alias("masked_column"),
        F.concat("p_name", F.lit(", \"quoted\"")).alias("Description"), F.lit("Numerical").alias("Type"))
    dictionary = read_dictionary(spark, _stored(spark, rows, write_csv))
    table = with_comments(spark.createDataFrame([], schemas.impressions()), dictionary)
    comments = spark.createDataFrame(
        [(f.name, f.metadata["comment"]) for f in table.schema.fields if "comment" in f.metadata],
        "masked_column string, comment string")
    return dictionary.join(comments, "masked_column", "left")


def csv_types(spark, sf):
    """Types learnt from a CSV's text."""
    df = views.impressions(spark, sf).select(
        "id1", "f1", (F.col("y") == 1).alias("flag"), F.concat(F.lit("w"), "id2").alias("word"),
        F.when(F.col("id1") % 3 == 0, F.col("id3")).alias("some"))
    return read_csv(spark, _stored(spark, df, write_csv))


def template_by_position(spark, sf):
    """A template whose rows name no row id: each gets the score that stands at its own place."""
    scored = views.scored(spark, sf).select("id1", "id2", "id3", F.col("first_score").alias("pred"))
    parts = []
    for df, files in ((scored.select(F.col("id1").alias("tag"), "id2", "id3"), 3), (scored.select("id1", "pred"), 5)):
        first = df.columns[0]
        df = df.repartitionByRange(files, first).sortWithinPartitions(first)
        parts.append(read_csv(spark, _stored(spark, df, write_csv), position="_position"))
    return match_by_position(*parts).withColumn("pred", F.round("pred", 6))


def bundle_round_trip(spark, sf):
    """Scores of a saved and loaded bundle against those of the one in memory."""
    bundle, _ = _bundle(spark, sf)
    path = _stored(spark, bundle, save_bundle)
    scored = [boosted.score(b, views.test(spark, sf), views.offers(spark, sf), views.trans(spark, sf), AS_OF)
              for b in (bundle, load_bundle(spark, path))]
    again = scored[1].select("id1", F.col("pred").alias("again"))
    return scored[0].join(again, "id1").select("id1", (F.col("pred") == F.col("again")).alias("same"))


def strict_timestamp(spark, sf):
    df = views.impressions(spark, sf).select("id1", F.date_format("id4", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return df.select("id1", strictly(F.col("text")).alias("parsed"))


def target_choice(spark, sf):
    df = views.impressions(spark, sf)
    both = df.withColumn("clicked", 1 - F.col("y"))
    return both.select("id1", F.col(columns.target_column(both)).alias("both"),
                       F.col(columns.target_column(df)).alias("one"))


def sorted_rows(spark, sf):
    """Rows in the order of their date, each with its place in that order."""
    rows = splits.numbered_by_date(views.impressions(spark, sf).select("id1", "id5"), "id5", "id1")
    return rows.select("id1", F.col("id5").cast("string").alias("id5"), "position")


def first_rows(spark, sf):
    return ranking.top(views.scored(spark, sf).select("id1", "first_score"), "first_score", 3, "id1")


@lru_cache(maxsize=1)
def all_queries() -> dict:
    names = """
        scan_parquet scan_tables missing_meta_defaults normalize_keys coerce_numeric parse_timestamp
        calendar_features offer_active_flag discount_bucket offer_meta_prep feature_projection
        align_features fill_nulls infer_numeric_columns column_all_zero join_offer_meta
        past_impressions rfm_features trans_features ctr_by_offer ctr_by_user ctr_encoding
        group_sizes variance_filter target_distribution label_encode joint_label_encode
        encode_unseen group_fold temporal_split random_split split_summary blend_scores
        hard_labels log_loss prediction_range rank_score dedupe_last template_match match_summary
        submission_ids map_at_5 feature_table training_table gbt_scores ensemble_scores
        top_importance submission rf_scores ranker_scores join_collisions variance_with_nan
        numeric_rule_types infer_date_format template_by_row csv_round_trip dictionary_comments
        bundle_round_trip strict_timestamp target_choice sorted_rows first_rows past_impressions_before
        balanced_folds balanced_folds_large exact_split csv_types template_by_position booster_tree
        booster_gains ranker_tree
    """.split()
    return {name: globals()[name] for name in names}
