"""Forest submission: click rates, a random forest, hard labels on the template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import hard_label
from ..operators.columns import align, drop_columns, numeric_columns
from ..operators.submission import match_template
from .features import click_rates, with_click_rates
from .models import assembled, fit_forest, score_forest

# Columns that are no features.
NO_FEATURES = ("id1", "id2", "id3", "id4")


def forest_scores(
    train: DataFrame, test: DataFrame, label: str = "y", trees: int = 100, depth: int = 10
) -> DataFrame:
    """Test rows (ids and ``pred``) scored by a forest on the numeric columns and click rates.

    A click rate that is unknown reads as the overall rate, any other missing number as 0.
    """
    rates_of = click_rates(train, label)  # used for both tables, aggregated once
    rated = with_click_rates(train, train, label, rates=rates_of)
    features = numeric_columns(drop_columns(rated, [*NO_FEATURES, label]))
    overall = train.agg(F.avg(label)).first()[0]
    rates = {"ctr_offer": overall, "ctr_user": overall}
    rated = rated.fillna(rates).fillna(0, subset=features)
    model = fit_forest(assembled(rated, features, label), features, trees, depth)
    keep = [c for c in ("id1", "id2", "id3") if c in test.columns]
    unlabelled = align(
        with_click_rates(test, train, label, rates=rates_of).fillna(rates), features, keep=keep
    ).fillna(0, subset=features)
    return score_forest(model, unlabelled).select(*keep, "pred")


def forest_submission(template: DataFrame, scored: DataFrame, order: str = "id1") -> DataFrame:
    """0/1 labels on the template's rows.

    A template with row ids gets each row's own score. Without them rows are matched by customer
    and offer; where a pair has several scores, the last in the order of a column that is numeric
    or a position (not of text, in which ``r9`` comes after ``r10``) counts.
    """
    by_row = "id1" in template.columns and "id1" in scored.columns
    keys = ("id1",) if by_row else ("id2", "id3")
    own = scored.select(*keys, "pred", F.col(order).alias("_order"))
    matched = match_template(template, own, "_order", keys=keys)
    return matched.withColumn("pred", hard_label(F.col("pred"))).drop("matched")
