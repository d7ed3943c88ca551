"""Saving and loading a trained forecaster as a folder.

``models/`` and ``peak_models/`` hold one MLlib model folder each, ``tables/``
one Parquet table each, and ``metadata`` a single row with everything else.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import (
    GBTRegressionModel,
    LinearRegressionModel,
    RandomForestRegressionModel,
)
from pyspark.sql import SparkSession

from ..models.least_squares import LinearModel
from ..models.peak_hour import PeakModel
from ..models.softmax import SoftmaxEnsemble
from ..models.trees import TreeEnsemble
from ..plans.training import Forecaster

_LOADERS = {
    kind.__name__: kind
    for kind in (
        GBTRegressionModel,
        LinearRegressionModel,
        RandomForestRegressionModel,
        RandomForestClassificationModel,
        TreeEnsemble,
        LinearModel,
        SoftmaxEnsemble,
    )
}


def _slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def save_artifacts(path: str, trained: Forecaster) -> None:
    """Write models and tables, then the metadata row that makes them loadable."""
    spark = next(iter(trained.tables.values())).sparkSession
    kinds, peak_kinds = {}, {}
    for name, model in trained.models.items():
        model.write().overwrite().save(f"{path}/models/{_slug(name)}")
        kinds[name] = type(model).__name__
    for name, fitted in trained.peak_models.items():
        peak_kinds[name] = {"kind": None, "labels": list(fitted.labels)}
        if fitted.model is not None:
            fitted.model.write().overwrite().save(f"{path}/peak_models/{_slug(name)}")
            peak_kinds[name]["kind"] = type(fitted.model).__name__
    for name, table in trained.tables.items():
        table.write.mode("overwrite").parquet(f"{path}/tables/{name}")
    metadata = {
        "profile": trained.profile,
        "series_cols": trained.series_cols,
        "features": trained.features,
        "daily_features": trained.daily_features,
        "best_model": trained.best_model,
        "models": kinds,
        "weights": trained.weights,
        "peak_models": peak_kinds,
        "peak_weights": trained.peak_weights,
        "peak_accuracy": trained.peak_accuracy,
        "tables": list(trained.tables),
    }
    row = spark.createDataFrame([(json.dumps(metadata),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_artifacts(spark: SparkSession, path: str) -> Forecaster:
    try:
        text = spark.read.text(f"{path}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no trained forecaster at {path}") from error
        raise
    if text is None:
        raise FileNotFoundError(f"no trained forecaster at {path}")
    metadata = json.loads(text[0])
    models = {
        name: _LOADERS[kind].load(f"{path}/models/{_slug(name)}")
        for name, kind in metadata.pop("models").items()
    }
    peak_models = {
        name: PeakModel(
            name,
            _LOADERS[entry["kind"]].load(f"{path}/peak_models/{_slug(name)}")
            if entry["kind"]
            else None,
            tuple(entry["labels"]),
        )
        for name, entry in metadata.pop("peak_models").items()
    }
    tables = {
        name: spark.read.parquet(f"{path}/tables/{name}") for name in metadata.pop("tables")
    }
    return Forecaster(models=models, peak_models=peak_models, tables=tables, **metadata)
