"""Model registry: named parts (Spark ML models and tables) with JSON metadata beside them."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .. import config


def _paths(root: str, name: str) -> tuple[str, str]:
    return f"{root}/{name}", f"{root}/{name}.meta"


def save_model(spark: SparkSession, root: str, name: str,
               parts: dict[str, PipelineModel | DataFrame],
               metadata: dict[str, Any] | None = None) -> str:
    """Store the parts, then the metadata; a model without metadata counts as absent."""
    artifact, meta_path = _paths(root, name)
    kinds = {}
    for part, obj in parts.items():
        if isinstance(obj, DataFrame):
            obj.write.mode("overwrite").parquet(f"{artifact}/{part}")
            kinds[part] = "table"
        else:
            obj.write().overwrite().save(f"{artifact}/{part}")
            kinds[part] = "model"
    meta = {**(metadata or {}), "name": name, "artifact": name, "parts": kinds,
            "saved_at": datetime.now(timezone.utc).isoformat()}
    spark.createDataFrame([(json.dumps(meta, default=str),)], "value string") \
        .write.mode("overwrite").text(meta_path)
    return artifact


def load_metadata(spark: SparkSession, root: str, name: str) -> dict[str, Any]:
    """The metadata of a model, empty if there is none."""
    try:
        row = spark.read.text(_paths(root, name)[1]).first()
    except AnalysisException:
        return {}
    return json.loads(row[0]) if row else {}


def model_exists(spark: SparkSession, root: str, name: str) -> bool:
    return bool(load_metadata(spark, root, name))


def load_model(spark: SparkSession, root: str, name: str) -> dict[str, PipelineModel | DataFrame]:
    meta = load_metadata(spark, root, name)
    if not meta:
        raise FileNotFoundError(f"model '{name}' not found under {root}; train it first")
    artifact, _ = _paths(root, name)
    return {part: spark.read.parquet(f"{artifact}/{part}") if kind == "table"
            else PipelineModel.load(f"{artifact}/{part}")
            for part, kind in meta["parts"].items()}


def metadata_table(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Rows (section, name, value): defaults, band edges and labels, metrics per model."""
    rows = [("default", k, str(v)) for k, v in vars(config.Assumptions()).items()]
    rows += [("band_edge", str(i), str(e)) for i, e in enumerate(config.BAND_EDGES)]
    rows += [("band_label", str(i), b) for i, b in enumerate(config.BAND_LABELS)]
    for name in names:
        metrics = load_metadata(spark, root, name).get("metrics", {})
        rows += [(name, k, str(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "section string, name string, value string")
