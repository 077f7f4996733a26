"""A fitted model with everything scoring needs, as a folder on shared storage."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.encoders import LabelEncoderModel
from ..operators.numeric_rule import NumericRuleModel


@dataclass
class Bundle:
    """``model`` assembles ``features`` and adds the scores; ``rule`` makes columns numeric."""

    model: PipelineModel
    features: list[str]
    target: str
    rule: NumericRuleModel | None = None
    config: dict = field(default_factory=dict)


def save_bundle(bundle: Bundle, path: str) -> None:
    """Write the bundle, replacing an older one.

    Model and classes go to a folder of their own each time; the manifest, written last, names it.
    So a bundle may be saved where it was loaded from, and a save that fails leaves the old one.
    Folders of older versions stay until ``drop_old_versions``.
    """
    spark = SparkSession.active()
    version = f"version-{uuid.uuid4().hex}"
    bundle.model.write().save(f"{path}/{version}/model")
    rule = bundle.rule
    encoder = rule.encoder if rule else None
    if encoder:
        encoder.table.write.parquet(f"{path}/{version}/classes")
    manifest = {
        "version": version,
        "features": bundle.features,
        "target": bundle.target,
        "config": bundle.config,
        "rule": rule and {
            "dates": rule.dates, "numeric": rule.numeric,
            "encoded": rule.encoded, "empty": rule.empty,
        },
        "encoder": encoder and {
            "columns": encoder.columns, "filler": encoder.filler, "sizes": encoder.sizes,
        },
    }
    saved = datetime.now(timezone.utc).isoformat()
    text = spark.createDataFrame([(saved, json.dumps(manifest))], "saved string, value string")
    text.coalesce(1).write.mode("append").json(f"{path}/manifest")


def _manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest that was written completely."""
    try:
        rows = spark.read.schema("saved string, value string").json(f"{path}/manifest")
        newest = rows.agg(F.max_by("value", "saved")).first()[0]
    except AnalysisException as e:
        raise FileNotFoundError(f"no fitted model at {path}; train and save one first") from e
    if newest is None:
        raise FileNotFoundError(f"no fitted model at {path}; train and save one first")
    return json.loads(newest)


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Delete every version but the newest. Bundles loaded from older ones stop working."""
    keep = _manifest(spark, path)["version"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in system.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name != keep:
            system.delete(entry.getPath(), True)


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    manifest = _manifest(spark, path)
    folder = f"{path}/{manifest['version']}"
    rule = None
    if manifest["rule"]:
        encoder = None
        if manifest["encoder"]:
            table = spark.read.schema("column string, value string, code bigint").parquet(
                f"{folder}/classes"
            )
            encoder = LabelEncoderModel(table, **manifest["encoder"])
        rule = NumericRuleModel(**manifest["rule"], encoder=encoder)
    return Bundle(
        PipelineModel.load(f"{folder}/model"), manifest["features"], manifest["target"],
        rule, manifest["config"],
    )
