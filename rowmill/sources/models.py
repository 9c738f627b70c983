"""Saved models and the reports that go with them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.classify import ClassifierFit
from rowmill.operators.linear import LinearFit, coefficient_table
from rowmill.sources.csv import write_csv

LINEAR_SCHEMA = (
    "model_type string, all_features array<string>, features array<string>, alpha double, l1_ratio double, "
    "coefficients array<double>, cv_scores array<double>, metrics map<string,double>, "
    "correlations array<struct<feature:string,correlation:double>>, notes string"
)
CLASSIFIER_SCHEMA = (
    "model_type string, features array<string>, classes array<string>, weights map<string,double>, "
    "per_class array<struct<class:string,precision:double,recall:double,f1:double,support:bigint>>, "
    "training_accuracy double, test_accuracy double"
)


class Evaluation(Protocol):
    """What a bundle keeps of an evaluation: measures per class on test rows, accuracy on training rows."""

    per_class: DataFrame | None
    training_accuracy: DataFrame | None


def save_linear(spark: SparkSession, fit: LinearFit, path: str, correlations: DataFrame | None = None) -> None:
    """Pipeline, metadata, coefficient table and training report under ``path``.

    ``correlations`` is the short list of strongest feature-target correlations.
    """
    fit.model.write().overwrite().save(f"{path}/model")
    strongest = [] if correlations is None else [(r["feature"], r["correlation"]) for r in correlations.collect()]
    record = (
        fit.model_type, fit.all_features, fit.features, fit.alpha, fit.l1_ratio, fit.coefficients, fit.cv_scores,
        fit.metrics, strongest, "target is log1p of the amount; expm1 takes predictions back",
    )
    metadata = spark.createDataFrame([record], LINEAR_SCHEMA).withColumn("trained_at", F.current_timestamp())
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    write_csv(coefficient_table(spark, fit.features, fit.coefficients).coalesce(1), f"{path}/coefficients")
    training_report(spark, fit).coalesce(1).write.mode("overwrite").json(f"{path}/report")


def load_linear(spark: SparkSession, path: str) -> LinearFit:
    """The model with its metadata; a missing model is an error."""
    try:
        row = spark.read.schema(LINEAR_SCHEMA).json(f"{path}/metadata").first()
    except AnalysisException as missing:
        raise FileNotFoundError(f"no trained model at {path}") from missing
    names = ["model_type", "features", "all_features", "alpha", "l1_ratio", "coefficients", "cv_scores"]
    fit = LinearFit(model=PipelineModel.load(f"{path}/model"), **{name: row[name] for name in names})
    return replace(fit, metrics=row["metrics"] or {})


def training_report(spark: SparkSession, fit: LinearFit, shown: int = 20) -> DataFrame:
    """``(section, position, metric, value)``: test metrics, model parameters, and the first features."""
    rows = [("test metrics", i, name, f"{value:.4f}") for i, (name, value) in enumerate(fit.metrics.items())]
    rows.append(("model parameters", 0, "best alpha", repr(fit.alpha)))
    if fit.l1_ratio is not None:
        rows.append(("model parameters", 1, "best l1_ratio", repr(fit.l1_ratio)))
    rows += [("selected features", i, str(i + 1), name) for i, name in enumerate(fit.features[:shown])]
    if len(fit.features) > shown:
        rows.append(("selected features", shown, "more", str(len(fit.features) - shown)))
    return spark.createDataFrame(rows, "section string, position int, metric string, value string")


def save_classifier(spark: SparkSession, fit: ClassifierFit, path: str, evaluation: Evaluation | None = None) -> None:
    """Indexer, scaler and model as one pipeline, in a folder per model type, with what was measured on test and training rows.

    A version is a folder of its own; ``published`` lists those that were written whole. A job that fails half way
    leaves the old model with its old metadata in place.
    """
    target, version = f"{path}/{fit.model_type}", uuid.uuid4().hex
    fit.model.write().overwrite().save(f"{target}/{version}/model")
    per_class = evaluation.per_class.collect() if evaluation is not None and evaluation.per_class is not None else []
    measured = [(r["class"], r["precision"], r["recall"], r["f1"], r["support"]) for r in per_class]
    on_training = evaluation.training_accuracy.first()["accuracy"] if evaluation is not None and evaluation.training_accuracy is not None else None
    hits = sum(r["recall"] * r["support"] for r in per_class)
    on_test = hits / sum(r["support"] for r in per_class) if per_class else None
    record = (fit.model_type, fit.features, fit.classes, fit.weights, measured, on_training, on_test)
    spark.createDataFrame([record], CLASSIFIER_SCHEMA).coalesce(1).write.json(f"{target}/{version}/metadata")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{target}/published")


def _published(spark: SparkSession, target: str) -> str:
    """The version that was written last and whole: the youngest file of the list of versions."""
    listed = spark.read.schema("version string").json(f"{target}/published")
    row = listed.select("version", "_metadata.file_modification_time", "_metadata.file_path").where("version IS NOT NULL").orderBy(F.desc("file_modification_time"), F.desc("file_path")).first()
    return f"{target}/{row['version']}"


def load_classifier(spark: SparkSession, path: str, model_type: str) -> ClassifierFit:
    version = _published(spark, f"{path}/{model_type}")
    row = spark.read.schema(CLASSIFIER_SCHEMA).json(f"{version}/metadata").first()
    return ClassifierFit(PipelineModel.load(f"{version}/model"), **{name: row[name] for name in ("model_type", "features", "classes", "weights")})


def load_evaluation(spark: SparkSession, path: str, model_type: str) -> DataFrame:
    """One row: the saved model's accuracies on test and training rows, and its measures per class as an array."""
    stored = spark.read.schema(CLASSIFIER_SCHEMA).json(f"{_published(spark, f'{path}/{model_type}')}/metadata")
    return stored.select("model_type", "test_accuracy", "training_accuracy", "per_class")


def write_class_report(per_class: Sequence[DataFrame] | DataFrame, path: str) -> None:
    """Per-class metrics of one or more models; a ``model_type`` column keeps them apart."""
    frames = [per_class] if isinstance(per_class, DataFrame) else list(per_class)
    table = frames[0]
    for frame in frames[1:]:
        table = table.unionByName(frame)
    write_csv(table.coalesce(1), path)
