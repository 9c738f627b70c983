"""Seniority classification: rule-based labels, balanced models, per-class reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.classify import ClassifierFit, MODEL_TYPES, classify, encode_labels, train_classifier
from rowmill.operators.evaluate import accuracy, class_metrics
from rowmill.operators.joins import align
from rowmill.operators.labels import LevelRules, keep_labelled, with_levels
from rowmill.operators.split import with_stratified_test_flag
from rowmill.plans import resume_values as v
from rowmill.plans.resume_features import LEVEL_RULES, experience_years
from rowmill.storage import materialize


def level_labels(raw: DataFrame, row_id: str, rules: LevelRules = LEVEL_RULES) -> DataFrame:
    """``(row_id, level, in_scope)`` for every record."""
    years = experience_years(named(v.EXPERIENCE)) if v.EXPERIENCE in raw.columns else None
    return with_levels(raw, rules, years).select(named(row_id), "level", "in_scope")


def classification_set(features: DataFrame, raw: DataFrame, row_id: str, rules: LevelRules = LEVEL_RULES) -> DataFrame:
    """Feature rows of the relevant records, with level and its code."""
    labels = keep_labelled(level_labels(raw, row_id, rules), rules)
    joined = align(features, labels.drop("in_scope"), row_id)
    return joined.withColumn("level_code", encode_labels(F.col("level"), v.LEVELS))


@dataclass(frozen=True)
class SeniorityResult:
    fit: ClassifierFit
    per_class: DataFrame | None
    scored: DataFrame | None
    training_accuracy: DataFrame | None = None


def train_seniority_models(
    table: DataFrame,
    features: Sequence[str],
    row_id: str,
    label: str = "level",
    model_types: Sequence[str] = MODEL_TYPES,
    test_share: float = 0.3,
    **training,
) -> dict[str, SeniorityResult]:
    """Train each model type on the same stratified split and score the test part.

    Too small a table is used for training as a whole, and yields no report.
    """
    parts = materialize(with_stratified_test_flag(table, row_id, label, test_share), "classes")
    train, test = parts.filter(~F.col("is_test")), parts.filter("is_test")
    testable = not test.isEmpty()
    results = {}
    for model_type in model_types:
        fit = train_classifier(train, features, label, model_type, **training)
        scored = classify(test, fit.model, fit.features) if testable else None
        report = None
        if testable:
            report = class_metrics(scored, label, "predicted").withColumn("model_type", F.lit(model_type))
        on_training = accuracy(classify(train, fit.model, fit.features), label, "predicted")
        results[model_type] = SeniorityResult(fit, report, scored, on_training)
    return results


def compare_models(results: dict[str, SeniorityResult]) -> DataFrame:
    """Per-class metrics of all model types in one table."""
    reports = [r.per_class for r in results.values() if r.per_class is not None]
    table = reports[0]
    for report in reports[1:]:
        table = table.unionByName(report)
    return table
