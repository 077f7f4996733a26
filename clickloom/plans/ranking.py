"""Ranking submission: encode, drop constant features, hold out a fold, rank per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import fold_of
from ..functions.values import filled_text
from ..operators.columns import align, date_columns, drop_columns, numeric_columns, text_columns
from ..operators.encoders import LabelEncoder
from ..operators.joins import HOT_ROWS
from ..operators.ranking import with_rank_score
from ..operators.selection import VarianceFilter
from ..session import discard, written
from .models import RANKER_BOOSTER, Boosting, assembled, fit_ranker, score_ranker

# Fixed values.
ID_PREFIX = "id"
ID_COLUMNS = ("id1", "id2", "id3", "id5")
NULL_CLASS = "nan"
FOLDS = 5
CUSTOMER = "_customer"


def encode_jointly(
    train: DataFrame, test: DataFrame, columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Codes over the values of both tables; a missing value is a class of its own."""
    if not columns:
        return train, test
    encoder = LabelEncoder(columns, filler=NULL_CLASS).fit(train, test)
    return encoder.transform(train), encoder.transform(test)


def rank_submission(
    train: DataFrame,
    test: DataFrame,
    label: str = "y",
    settings: Boosting = RANKER_BOOSTER,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """id1, id2, id3, id5 of the test rows and the score scaled within the customer."""
    features = drop_columns(train, [label], prefix=ID_PREFIX).columns
    # dates stored as such count as their text, as they do when they come from CSV
    dates = [c for c in date_columns(train) if c in features]
    train, test = (df.withColumns({c: F.col(c).cast("string") for c in dates if c in df.columns})
                   if dates else df for df in (train, test))
    texts = [c for c in text_columns(train) if c in features]
    train, test = encode_jointly(train, test, texts)
    numeric = [c for c in features if c in numeric_columns(train)]
    kept = VarianceFilter().fit(train, numeric).kept
    train = train.fillna(0, subset=kept)
    test = align(test, kept, keep=ID_COLUMNS).fillna(0, subset=kept)
    customer = filled_text(F.col("id2"), NULL_CLASS)
    held_out = F.coalesce(fold_of(customer, FOLDS) == 0, F.lit(False))
    rows = assembled(train.withColumn(CUSTOMER, customer), kept, label, held_out, keep=[CUSTOMER])
    model = fit_ranker(rows, kept, settings, F.col(CUSTOMER))
    discard(rows)
    # read twice below, for the range per customer and for the rows: score once
    scored = written(score_ranker(model, test).select(*ID_COLUMNS, "pred"), "scores")
    ranked = with_rank_score(scored, hot_rows=hot_rows)
    return ranked.select(*ID_COLUMNS, F.col("rank_score").alias("pred"))
