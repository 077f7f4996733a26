"""The training table: impressions, offer metadata and transaction features, all numeric."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.offers import UNKNOWN_BUCKET, active_flag, discount_bucket
from ..functions.values import number, parse_timestamp, wall_clock
from ..operators.aggregates import transaction_features
from ..operators.columns import keep_existing, target_column, text_columns, with_defaults
from ..operators.joins import HOT_ROWS, Lookup, attach
from ..operators.numeric_rule import NumericRule, NumericRuleModel

# Fixed values.
ID_COLUMNS = ("id1", "id2", "id3", "id5")
META_COLUMNS = ("id3", "is_currently_active", "discount_bucket", "id9", "f375", "f376", "id10", "id11")
META_DATES = ("f374", "id13", "id12")
META_DEFAULTS = {"is_currently_active": 1, "discount_bucket": UNKNOWN_BUCKET}
TRANS_FILL = {"trans_cnt": 0, "trans_amt_sum": 0.0, "trans_amt_mean": 0.0}
AS_OF = datetime(2023, 11, 5)
SPLIT_DATE = datetime(2023, 11, 3)


def offer_meta(
    offers: DataFrame, as_of: datetime = AS_OF, date_formats: Sequence[str] = ()
) -> DataFrame:
    """Active flag, discount bucket and the descriptive columns of each offer."""
    texts = text_columns(offers)
    dates = {
        c: parse_timestamp(F.col(c), date_formats)
        for c in META_DATES if c in texts
    }
    df = offers.withColumns(dates) if dates else offers
    active = F.lit(META_DEFAULTS["is_currently_active"])
    if "id12" in df.columns and "id13" in df.columns:
        active = active_flag(F.col("id12"), F.col("id13"), wall_clock(as_of))
    bucket = F.lit(META_DEFAULTS["discount_bucket"])
    if "f376" in df.columns:
        bucket = discount_bucket(number(df, "f376"))
    return keep_existing(
        df.withColumns({"is_currently_active": active, "discount_bucket": bucket}), META_COLUMNS
    )


def with_offer_meta(
    df: DataFrame, offers: DataFrame | None, as_of: datetime = AS_OF,
    date_formats: Sequence[str] = (), null_safe: bool = False,
) -> DataFrame:
    """Attach the offer columns, or their constants where there is no offer table."""
    if offers is None:
        return with_defaults(df, META_DEFAULTS)
    meta = offer_meta(offers, as_of, date_formats)
    return attach(df, [Lookup(meta, ["id3"], null_safe=null_safe, dimension=True)])


def with_transactions(
    df: DataFrame, trans: DataFrame | None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Attach the transaction features, or zeros where there is no usable transaction table."""
    if trans is None or not {"id2", "f367"} <= set(trans.columns):
        return with_defaults(df, TRANS_FILL)
    return attach(df, [Lookup(transaction_features(trans), ["id2"], TRANS_FILL)], hot_rows=hot_rows)


def build_training_table(
    impressions: DataFrame,
    offers: DataFrame | None,
    trans: DataFrame | None,
    as_of: datetime = AS_OF,
    dates: Sequence[str] = (),
    date_formats: Sequence[str] = (),
    target: str | None = None,
    null_safe: bool = False,
) -> tuple[DataFrame, NumericRuleModel]:
    """Ids, numeric features and target, with the fitted rule that made the features numeric.

    The rule concerns text columns only, so it is fitted before the transactions are attached.
    """
    target = target or target_column(impressions)
    aside = [*[c for c in ID_COLUMNS if c in impressions.columns], target]
    df = with_offer_meta(impressions, offers, as_of, date_formats, null_safe)
    rule = NumericRule(dates).fit(df.drop(*aside))
    df = with_transactions(df, trans)
    ids = df.select(*[F.col(c).alias(f"_aside_{c}") if c in aside else c for c in df.columns])
    out = rule.transform(ids, skip=[f"_aside_{c}" for c in aside])
    return out.withColumnsRenamed({f"_aside_{c}": c for c in aside}), rule


def feature_columns(df: DataFrame, target: str) -> list[str]:
    return [c for c in df.columns if c not in ID_COLUMNS and c != target]
