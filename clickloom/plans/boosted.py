"""Train the boosted pair, judge it, and score new impressions with it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import infer_date_format, number, parse_timestamp, wall_clock
from ..operators.columns import align, target_column, text_columns
from ..operators.encoders import LabelEncoder
from ..operators.metrics import log_losses
from ..operators.numeric_rule import NumericRuleModel
from ..operators.splits import in_sample
from ..operators.submission import format_submission, usable
from ..sources.bundle import Bundle
from .models import HELD_OUT, LABEL, SECOND_BOOSTER, SEED, Boosting, assembled, fit_pair, score_pair
from .training import (
    AS_OF, ID_COLUMNS, SPLIT_DATE, build_training_table, feature_columns, with_offer_meta, with_transactions,
)

# The text columns scoring encodes, and the filler for their missing values.
SERVED_TEXTS = ("discount_bucket", "id9", "id10", "id11")
SERVED_FILLER = "missing"


def train(
    impressions: DataFrame,
    offers: DataFrame | None,
    trans: DataFrame | None,
    as_of: datetime = AS_OF,
    split: datetime = SPLIT_DATE,
    dates: Sequence[str] = (),
    date_formats: Sequence[str] = (),
    first: Boosting = Boosting(),
    second: Boosting | None = SECOND_BOOSTER,
) -> tuple[Bundle, DataFrame]:
    """The fitted bundle and the scored validation rows.

    Validation is from ``split`` on by id5; text is parsed by ``date_formats``, or by the format
    that most of its values have. Without id5 it is a fifth of the rows by hash of id1.
    """
    target = target_column(impressions)
    table, rule = build_training_table(
        impressions, offers, trans, as_of, dates, date_formats, target
    )
    features = feature_columns(table, target)
    if "id5" in table.columns:
        if "id5" in text_columns(table):
            formats = date_formats or infer_date_format(impressions, "id5")
            table = table.withColumn("id5", parse_timestamp(F.col("id5"), formats))
        held_out = F.col("id5") >= wall_clock(split)
        table = table.where(held_out.isNotNull())  # a row without a date is in neither part
    else:
        held_out = in_sample(F.col("id1"), 0.2, SEED)
    ids = [c for c in ID_COLUMNS if c in table.columns]
    rows = assembled(table, features, target, held_out, keep=[*ids, target])
    model = fit_pair(rows, features, first, second)
    config = {"as_of": as_of.isoformat(), "split": split.isoformat()}
    scored = score_pair(model, rows.where(F.col(HELD_OUT))).drop(LABEL, HELD_OUT)
    return Bundle(model, features, target, rule, config), scored


def validation_losses(scored: DataFrame, target: str) -> DataFrame:
    """Log loss of each score there is: first, second, blend."""
    names = {"first_loss": "first_score", "second_loss": "second_score", "blend_loss": "pred"}
    return log_losses(scored, target, {n: c for n, c in names.items() if c in scored.columns})


def serving_rule(df: DataFrame, rule: NumericRuleModel, aside: Sequence[str]) -> DataFrame:
    """The scoring side's own encoding: four texts by the known classes, any other text a number.

    A missing text reads ``missing``; a value without a class gets the first one. A column that
    was never encoded in training is fitted on the rows at hand.
    """
    known = rule.encoder.columns if rule.encoder else []
    there = [c for c in SERVED_TEXTS if c in df.columns]
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(SERVED_FILLER)) for c in there})
    trained = [c for c in there if c in known]
    fresh = [c for c in there if c not in known]
    if trained:
        df = rule.encoder.transform(df, unseen="first", columns=trained)
    if fresh:
        df = LabelEncoder(fresh).fit(df).transform(df)
    others = [c for c in text_columns(df) if c not in aside]
    return df.withColumns({c: number(df, c, 0.0) for c in others}) if others else df


def score(
    bundle: Bundle,
    impressions: DataFrame,
    offers: DataFrame | None,
    trans: DataFrame | None,
    as_of: datetime = AS_OF,
    date_formats: Sequence[str] = (),
    shared_encoding: bool = True,
) -> DataFrame:
    """Impressions with their ids and ``pred``.

    ``shared_encoding`` applies the rule fitted in training; without it the scoring side's own
    rule is used (see ``serving_rule``). Features the rows lack become 0.
    """
    ids = [c for c in ID_COLUMNS if c in impressions.columns]
    df = with_transactions(with_offer_meta(impressions, offers, as_of, date_formats), trans)
    df = df.withColumns({f"_aside_{c}": F.col(c) for c in ids})
    aside = [f"_aside_{c}" for c in ids]
    if shared_encoding:
        df = bundle.rule.transform(df, skip=aside)
    else:
        df = serving_rule(df, bundle.rule, aside)
    df = align(df, bundle.features, keep=aside, default=0.0)
    df = df.fillna(0, subset=bundle.features)
    scored = score_pair(bundle.model, df)
    return scored.select(*[F.col(f"_aside_{c}").alias(c) for c in ids], "pred")


def submission(
    bundle: Bundle,
    impressions: DataFrame,
    offers: DataFrame | None,
    trans: DataFrame | None,
    as_of: datetime = AS_OF,
    date_formats: Sequence[str] = (),
    shared_encoding: bool = True,
    keep: set[str] | None = None,
) -> DataFrame:
    """Scored impressions in the layout of a submission."""
    keep = usable(impressions) if keep is None else keep
    scored = score(bundle, impressions, offers, trans, as_of, date_formats, shared_encoding)
    return format_submission(scored, keep, date_formats=tuple(date_formats))
