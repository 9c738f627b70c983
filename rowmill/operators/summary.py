"""One-row summaries and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.quantiles import exact_quantiles


def _missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def corrected_skewness(x: Column) -> Column:
    """Sample skewness with bias correction; null for fewer than three values or no spread."""
    n = F.count(x)
    population = F.when(F.stddev_pop(x) > 0, F.skewness(x))
    return F.when(n > 2, population * F.sqrt(n * (n - 1)) / F.greatest(n - 2, F.lit(1)))


def value_summary(df: DataFrame, column: str, positive_only: bool = False) -> DataFrame:
    """Values, min, max, mean and exact median of one column, for all rows or the positive ones."""
    x = named(column)
    values = df.filter(x > 0) if positive_only else df
    median = exact_quantiles(values, [column], [0.5])[column][0]
    return values.agg(
        F.count(x).alias("n"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
    ).withColumn("median", F.lit(median).cast("double"))


def quality_report(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row: missing and infinite cells, spread of the feature matrix and of the target.

    The matrix mean and deviation are those of all cells together, so they follow from per-column
    counts, sums and squares of a single pass. ``target_unusual`` marks a target that looks unscaled.
    """
    cells = [named(c).cast("double") for c in features]
    y = named(target).cast("double")

    def total(parts: list[Column]) -> Column:
        return sum(parts[1:], parts[0])

    zero = F.lit(0.0)
    finite = [F.when(~_missing(c), c) for c in cells]
    measures = {
        "rows": F.count(F.lit(1)),
        "x_missing": total([F.count_if(_missing(c)) for c in cells]),
        "y_missing": F.count_if(_missing(y)),
        "x_infinite": total([F.count_if(F.abs(c) == float("inf")) for c in cells]),
        "y_infinite": F.count_if(F.abs(y) == float("inf")),
        "cells": total([F.count(c) for c in finite]),
        "x_min": F.least(*[F.min(c) for c in finite]) if len(cells) > 1 else F.min(finite[0]),
        "x_max": F.greatest(*[F.max(c) for c in finite]) if len(cells) > 1 else F.max(finite[0]),
        "x_sum": total([F.coalesce(F.sum(c), zero) for c in finite]),
        # squares about the mean, per column; shifted to the common mean below
        "within": total([F.coalesce(F.var_pop(c) * F.count(c), zero) for c in finite]),
        "y_mean": F.avg(y),
        "y_std": F.stddev_pop(y),
        "y_min": F.min(y),
        "y_max": F.max(y),
        "y_skewness": F.when(F.stddev_pop(y) > 0, F.skewness(y)),
        "y_skewness_corrected": corrected_skewness(y),
    }
    for i, c in enumerate(finite):
        measures[f"mean_{i}"] = F.avg(c)
        measures[f"n_{i}"] = F.count(c)
    row = df.agg(*[m.alias(name) for name, m in measures.items()])
    x_mean = F.try_divide(F.col("x_sum"), F.col("cells"))
    row = row.withColumn("x_mean", x_mean)
    between = total(
        [
            F.coalesce(F.col(f"n_{i}") * (F.col(f"mean_{i}") - F.col("x_mean")) ** 2, zero)
            for i in range(len(cells))
        ]
    )
    row = row.withColumn("x_std", F.sqrt(F.try_divide(F.col("within") + between, F.col("cells"))))
    row = row.withColumn("target_unusual", (F.abs("y_mean") > 1.0) | (F.col("y_std") > 10.0))
    dropped = ["cells", "x_sum", "within", *[f"{p}_{i}" for i in range(len(cells)) for p in ("mean", "n")]]
    return row.drop(*dropped)


def back_transformed_sample(df: DataFrame, target: str, row_id: str, rows: int = 100) -> DataFrame:
    """Range of the first ``rows`` targets on the original scale."""
    head = df.orderBy(named(row_id)).limit(rows).select(F.expm1(named(target)).alias("y"))
    return head.agg(F.min("y").alias("min"), F.max("y").alias("max"))
