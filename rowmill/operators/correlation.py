"""Correlations between features, and between features and target."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.columns import numeric_columns
from rowmill.operators.moments import BLOCK, correlations_with, pair_moments, pair_table
from rowmill.storage import materialize


def correlation_array(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """k×k Pearson matrix, each pair over the rows where both are present; NaN for constants."""
    return pair_moments(df, columns).correlations()


def correlation_table(spark: SparkSession, columns: Sequence[str], matrix: np.ndarray) -> DataFrame:
    """Upper triangle of a correlation matrix as rows; a constant column has null correlations."""
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i < j
    ]
    return spark.createDataFrame(rows, "feature string, other string, correlation double").withColumn(
        "abs_correlation", F.abs("correlation")
    )


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, feature, other, correlation, abs_correlation`` for every pair of columns and each with itself, however many there are.

    Written once, as several questions are asked of it.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "i int, j int, feature string, other string, correlation double, abs_correlation double")
    names = F.array(*map(F.lit, columns))
    pairs = materialize(pair_table(df, columns), "pairs")
    return pairs.select("i", "j", names[F.col("i")].alias("feature"), names[F.col("j")].alias("other"), "correlation", F.abs("correlation").alias("abs_correlation"))


def strong_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different columns above ``threshold``, with the mean absolute correlation of either column (to twelve digits)."""
    known = pairs.where("correlation IS NOT NULL")
    ends = known.select("i", "abs_correlation").unionByName(known.where("i < j").select(F.col("j").alias("i"), "abs_correlation"))
    means = ends.groupBy("i").agg(F.round(F.avg("abs_correlation"), 12).alias("mean"))
    strong = known.where((F.col("i") < F.col("j")) & (F.col("abs_correlation") > threshold))
    of_i, of_j = means.withColumnRenamed("mean", "mean_i"), means.select(F.col("i").alias("j"), F.col("mean").alias("mean_j"))
    return strong.join(of_i, "i").join(of_j, "j")


def near_duplicate_pairs(table: DataFrame, threshold: float = 0.99) -> DataFrame:
    """Number of feature pairs correlated above ``threshold``, in a one-row table."""
    return table.agg(F.count_if(F.col("abs_correlation") > threshold).alias("near_duplicate_pairs"))


def collinear_columns(columns: Sequence[str], matrix: np.ndarray, threshold: float) -> list[str]:
    """Columns to drop so that no strong pair stays whole.

    Pairs are visited in column order. Of a pair above ``threshold`` the column with the larger mean
    absolute correlation goes, on a tie the later one; a column that goes ends its own row of pairs.
    """
    strength = np.abs(matrix)
    valid = ~np.isnan(strength)
    mean = np.where(valid, strength, 0.0).sum(axis=0) / np.maximum(valid.sum(axis=0), 1)
    k = len(columns)
    strong = {i: [j for j in range(i + 1, k) if valid[i, j] and strength[i, j] > threshold] for i in range(k)}
    dropped = _dropped(strong, mean)
    return [name for i, name in enumerate(columns) if i in dropped]


def _dropped(strong: Mapping[int, Sequence[int]], mean: Mapping[int, float]) -> set[int]:
    """Positions to drop; ``strong`` lists the later partners of each column, in order."""
    dropped: set[int] = set()
    for i in sorted(strong):
        weaker = next((at for at, j in enumerate(strong[i]) if mean[i] > mean[j]), None)
        dropped.update(strong[i][:weaker])
        if weaker is not None:
            dropped.add(i)
    return dropped


def collinear_from_pairs(columns: Sequence[str], pairs: DataFrame, threshold: float) -> list[str]:
    """``collinear_columns`` from the table of pairs: only pairs above the threshold come to the driver. Means that agree to twelve digits tie."""
    strong: dict[int, list[int]] = {}
    mean: dict[int, float] = {}
    for row in strong_pairs(pairs, threshold).select("i", "j", "mean_i", "mean_j").collect():
        strong.setdefault(row["i"], []).append(row["j"])
        mean[row["i"]], mean[row["j"]] = row["mean_i"], row["mean_j"]
    dropped = _dropped({i: sorted(later) for i, later in strong.items()}, mean)
    return [name for i, name in enumerate(columns) if i in dropped]


def fit_collinear(df: DataFrame, threshold: float = 0.9, exclude: Iterable[str] = ()) -> list[str]:
    columns = numeric_columns(df, exclude)
    if len(columns) < 2:
        return []
    if len(columns) <= BLOCK:  # the whole matrix is small
        return collinear_columns(columns, correlation_array(df, columns), threshold)
    return collinear_from_pairs(columns, pair_correlations(df, columns), threshold)


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(position, feature, correlation, abs_correlation)`` for every feature that varies, in one pass."""
    found = correlations_with(df, features, target)
    rows = [(i, name, r) for i, (name, r) in enumerate(zip(features, found)) if not np.isnan(r)]
    listed = df.sparkSession.createDataFrame(rows, "position int, feature string, correlation double")
    return listed.withColumn("abs_correlation", F.abs("correlation"))


def strongest(correlations: DataFrame, k: int) -> DataFrame:
    """Top ``k`` by absolute correlation, ties to the later feature, with its direction."""
    return (
        correlations.orderBy(F.desc("abs_correlation"), F.desc("position"))
        .limit(k)
        .withColumn("direction", F.when(F.col("correlation") > 0, "up").otherwise("down"))
    )


def select_features(df: DataFrame, features: Sequence[str], target: str, k: int) -> list[str]:
    """Names of the top ``k`` features, strongest first; all of them in order if there are no more."""
    if k >= len(features):
        return list(features)
    return [row["feature"] for row in strongest(target_correlations(df, features, target), k).collect()]
