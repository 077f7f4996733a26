"""Tree models: the boosted pair, the forest and the ranker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..boosting.fit import Boosting, best_round, fit
from ..boosting.forest import fit_forest as grow_forest
from ..boosting.objectives import LISTWISE
from ..functions.scores import blend
from ..session import written

SEED = 42
FEATURES, LABEL, HELD_OUT = "features", "label", "_held_out"
FIRST, SECOND, FOREST, RANKER = "first", "second", "forest", "ranker"


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def assembled(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    held_out: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep``, label, hold-out flag and feature vector, written once.

    Boosting reads these rows every round; joins and encodings must not run again each time.
    """
    flag = F.lit(False) if held_out is None else held_out
    vectors = assembler(features).transform(df.withColumn(HELD_OUT, flag))
    return written(
        vectors.select(*keep, F.col(label).cast("double").alias(LABEL), HELD_OUT, FEATURES),
        "training",
    )


# Settings of the second booster (levels, penalty, rows and columns drawn for every tree).
SECOND_BOOSTER = Boosting(
    seed=SEED + 1, depth=6, l2=1.0, min_curvature=1.0, min_rows=1, row_every=1, bins=256)
# Settings of the ranker.
RANKER_BOOSTER = Boosting(rounds=500, patience=40, leaves=63, row_every=3, objective=LISTWISE)


def fit_pair(
    rows: DataFrame,
    features: Sequence[str],
    first: Boosting = Boosting(),
    second: Boosting | None = SECOND_BOOSTER,
) -> PipelineModel:
    """Two boosted classifiers on the same assembled rows (or one), as one model with two scores.

    Held-out rows, if there are any, are not learnt from but choose the number of rounds. Both are fitted
    in the same passes over the rows.
    """
    settings = {name: s for name, s in ((FIRST, first), (SECOND, second)) if s is not None}
    fitted = fit(rows, list(settings.values()), list(settings), FEATURES, LABEL, F.col(HELD_OUT))
    return PipelineModel([assembler(features), *fitted])


def fit_forest(
    rows: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 10, seed: int = SEED
) -> PipelineModel:
    """A random forest on 0/1 labels; nodes draw from the square root of the features, trees draw their rows."""
    model = grow_forest(rows, FOREST, FEATURES, LABEL, F.col(HELD_OUT), trees, depth, seed)
    return PipelineModel([assembler(features), model])


def fit_ranker(
    rows: DataFrame, features: Sequence[str], settings: Boosting = RANKER_BOOSTER, lists: Column | None = None
) -> PipelineModel:
    """Trees boosted for the order within a list (a customer's offers), or pointwise for the squared objective.

    With held-out lists, training stops by their mean average precision.
    """
    (model,) = fit(rows, [settings], [RANKER], FEATURES, LABEL, F.col(HELD_OUT), lists)
    return PipelineModel([assembler(features), model])


def _transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows that are assembled already skip the first stage."""
    stages = model.stages[1:] if FEATURES in df.columns else model.stages
    return PipelineModel(stages).transform(df)


def score_pair(model: PipelineModel, df: DataFrame, name: str = "pred") -> DataFrame:
    """Scores of the pair and their blend; the first alone if there is no second."""
    keep = [c for c in df.columns if c != FEATURES]
    names = [s.name for s in model.stages[1:]]
    scored = _transform(model, df)
    columns = [F.col(f"{n}_score") for n in names]
    return scored.select(*keep, *columns, blend(*columns).alias(name))


def score_forest(model: PipelineModel, df: DataFrame, name: str = "pred") -> DataFrame:
    return model.transform(df).select(*df.columns, F.col(f"{FOREST}_score").alias(name))


def score_ranker(model: PipelineModel, df: DataFrame, name: str = "pred") -> DataFrame:
    return model.transform(df).select(*df.columns, F.col(f"{RANKER}_score").alias(name))


def importances(model: PipelineModel, features: Sequence[str], stage: int = 1) -> DataFrame:
    """Gain of each feature in one of the model's boosters, its share of all gain, and its splits."""
    gains = model.stages[stage].gains(list(features))
    total = gains.agg(F.sum("gain")).first()[0] or 1.0  # one row per feature
    return gains.select("feature", "gain", "splits", (F.col("gain") / total).alias("importance"))
