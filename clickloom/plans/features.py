"""The feature table: impressions with offer metadata, past impressions and RFM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import key_long, key_text
from ..operators.aggregates import click_rate, impression_counts, rfm
from ..operators.joins import HOT_ROWS, Lookup, attach
from ..session import written

# What an impression without history or transactions gets.
COUNT_FILL = {"past_impression_count": 0}
RFM_FILL = {"recency": 0, "frequency": 0, "monetary": 0.0}


def normalize_keys(df: DataFrame) -> DataFrame:
    """Customer key as text, offer key as bigint, where they are columns."""
    change = {}
    if "id2" in df.columns:
        change["id2"] = key_text(F.col("id2"))
    if "id3" in df.columns:
        change["id3"] = key_long(F.col("id3"))
    return df.withColumns(change)


def build_features(
    impressions: DataFrame,
    offers: DataFrame,
    events: DataFrame,
    trans: DataFrame,
    as_of: datetime,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per impression (and per copy of its offer); training and test rows alike."""
    return attach(
        normalize_keys(impressions),
        [
            Lookup(normalize_keys(offers), ["id3"], dimension=True),
            Lookup(impression_counts(normalize_keys(events)), ["id2", "id3"], COUNT_FILL),
            Lookup(rfm(normalize_keys(trans), as_of), ["id2"], RFM_FILL),
        ],
        hot_rows=hot_rows,
    )


def click_rates(train: DataFrame, label: str = "y") -> tuple[DataFrame, DataFrame]:
    """Click rate per offer and per customer, written once for use on several tables."""
    return (written(click_rate(train, "id3", label, "ctr_offer"), "offer-rates"),
            written(click_rate(train, "id2", label, "ctr_user"), "customer-rates"))


def with_click_rates(
    df: DataFrame, train: DataFrame, label: str = "y", hot_rows: int = HOT_ROWS,
    rates: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Click rate of the offer and of the customer over ``train``; missing where it has neither.

    ``rates`` are those of ``click_rates``, if they are at hand.
    """
    by_offer, by_customer = rates or (
        click_rate(train, "id3", label, "ctr_offer"), click_rate(train, "id2", label, "ctr_user"))
    return attach(
        df, [Lookup(by_offer, ["id3"]), Lookup(by_customer, ["id2"])], hot_rows=hot_rows)
