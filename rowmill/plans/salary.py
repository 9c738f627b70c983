"""Salary regression: split, train, evaluate, report."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import quality_band
from rowmill.operators.correlation import strongest, target_correlations
from rowmill.operators.evaluate import regression_metrics, sample_predictions
from rowmill.operators.linear import LinearFit, coefficient_table, predict, train_linear
from rowmill.operators.split import with_test_flag
from rowmill.plans.prepare import Prepared
from rowmill.storage import materialize


@dataclass(frozen=True)
class SalaryModel:
    fit: LinearFit
    metrics: DataFrame
    correlations: DataFrame
    coefficients: DataFrame
    examples: DataFrame


def train_salary_model(
    prepared: Prepared, model_type: str = "ridge", n_features: int = 15, test_percent: int = 20
) -> SalaryModel:
    """Train on a hashed share of the rows and measure on the rest."""
    spark = prepared.table.sparkSession
    table = materialize(with_test_flag(prepared.table, prepared.row_id, test_percent), "matrix")
    train, test = table.filter(~F.col("is_test")), table.filter("is_test")
    fit = train_linear(train, prepared.features, prepared.target, prepared.row_id, model_type, n_features)
    scored = predict(test, fit.model, fit.features, as_log=True)
    metrics = regression_metrics(scored, prepared.target, "prediction").withColumn(
        "quality", quality_band(F.col("r2_amount"))
    )
    numbers = {k: float(x) for k, x in metrics.drop("quality").first().asDict().items() if x is not None}
    return SalaryModel(
        fit=replace(fit, metrics={**numbers, "best_alpha": fit.alpha}),
        metrics=metrics,
        correlations=strongest(target_correlations(table, prepared.features, prepared.target), 20),
        coefficients=coefficient_table(spark, fit.features, fit.coefficients),
        examples=sample_predictions(scored, prepared.target, "prediction", prepared.row_id),
    )
