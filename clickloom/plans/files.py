"""The flows from stored tables to stored results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.columns import target_column
from ..operators.submission import match_by_position, match_template
from ..sources.bundle import load_bundle, save_bundle
from ..sources.schemas import EVENTS, TRANSACTIONS
from ..sources.tables import read_csv, read_parquet, write_csv, write_parquet
from .boosted import submission, train, validation_losses
from .features import build_features
from .forest import forest_scores, forest_submission
from .models import RANKER_BOOSTER, SECOND_BOOSTER, Boosting
from .ranking import rank_submission
from .training import AS_OF, SPLIT_DATE

# Amounts stay text: how much of one is a number is decided later.
AMOUNTS = T.StructType([f for f in TRANSACTIONS.fields if f.name == "f367"])


def read_table(
    spark: SparkSession, path: str, declared: T.StructType | None = None, position: str | None = None
) -> DataFrame:
    """Parquet, or CSV where the path ends in .csv; CSV types that are not declared are learnt from the data."""
    if path.endswith(".csv"):
        return read_csv(spark, path, declared=declared, position=position, lenient=False)
    return read_parquet(spark, path, position=position)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    write = write_csv if path.endswith(".csv") else write_parquet
    write(df, path, mode)


def feature_files(
    spark: SparkSession, train_path: str, test_path: str, offers_path: str, events_path: str,
    trans_path: str, train_out: str, test_out: str, as_of: datetime, mode: str = "error",
) -> None:
    """Feature tables of the training and the test rows."""
    offers, events = read_table(spark, offers_path), read_table(spark, events_path, EVENTS)
    trans = read_table(spark, trans_path, AMOUNTS)
    for source, target in ((train_path, train_out), (test_path, test_out)):
        rows = read_table(spark, source)
        write_table(build_features(rows, offers, events, trans, as_of), target, mode)


def train_files(
    spark: SparkSession, train_path: str, offers_path: str | None, trans_path: str | None,
    bundle_path: str, as_of: datetime = AS_OF, split: datetime = SPLIT_DATE,
    dates: Sequence[str] = (), date_formats: Sequence[str] = (),
    first: Boosting = Boosting(), second: Boosting | None = SECOND_BOOSTER,
) -> DataFrame:
    """Fit and save the boosted pair; the validation losses."""
    rows = read_table(spark, train_path)
    offers = read_table(spark, offers_path) if offers_path else None
    trans = read_table(spark, trans_path, AMOUNTS) if trans_path else None
    bundle, scored = train(rows, offers, trans, as_of, split, dates, date_formats, first, second)
    save_bundle(bundle, bundle_path)
    return validation_losses(scored, target_column(rows))


def score_files(
    spark: SparkSession, bundle_path: str, test_path: str, offers_path: str | None,
    trans_path: str | None, out: str, as_of: datetime = AS_OF, date_formats: Sequence[str] = (),
    shared_encoding: bool = True, mode: str = "error",
) -> None:
    """Submission of the test rows by a saved pair."""
    bundle = load_bundle(spark, bundle_path)
    offers = read_table(spark, offers_path) if offers_path else None
    trans = read_table(spark, trans_path, AMOUNTS) if trans_path else None
    result = submission(
        bundle, read_table(spark, test_path), offers, trans, as_of, date_formats, shared_encoding
    )
    write_table(result, out, mode)


def template_files(
    spark: SparkSession, template_path: str, predictions_path: str, out: str, mode: str = "error",
    by_position: bool = False,
) -> DataFrame:
    """Template rows with the last prediction of their key in the CSV, or with the one at their own place
    (``by_position``); also as the result."""
    predictions = read_csv(spark, predictions_path, position="_position")
    if by_position:
        matched = match_by_position(read_table(spark, template_path, position="_position"), predictions)
        write_table(matched.drop("matched"), out, mode)
        return matched
    matched = match_template(read_table(spark, template_path), predictions, "_position")
    write_table(matched.drop("matched"), out, mode)
    return matched


def rank_files(
    spark: SparkSession, train_path: str, test_path: str, out: str,
    settings: Boosting = RANKER_BOOSTER, mode: str = "error",
) -> None:
    """Ranking submission from stored feature tables."""
    result = rank_submission(
        read_table(spark, train_path), read_table(spark, test_path), settings=settings
    )
    write_table(result, out, mode)


def forest_files(
    spark: SparkSession, train_path: str, test_path: str, template_path: str, out: str,
    trees: int = 100, depth: int = 10, mode: str = "error",
) -> None:
    """Forest submission from stored feature tables."""
    scored = forest_scores(
        read_table(spark, train_path), read_table(spark, test_path), trees=trees, depth=depth
    )
    result = forest_submission(read_table(spark, template_path), scored, "id1")
    write_table(result, out, mode)
