"""Outlier bounds and what to do with values beyond them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import clip
from rowmill.functions.text import named
from rowmill.operators.columns import numeric_columns, replace_columns
from rowmill.operators.moments import column_stats
from rowmill.operators.quantiles import exact_quantiles

Bounds = Mapping[str, tuple[float, float]]


def fit_bounds(
    df: DataFrame, detector: str = "iqr", threshold: float = 1.5, columns: Sequence[str] | None = None
) -> dict[str, tuple[float, float]]:
    """(low, high) per column: quartiles ∓ threshold·IQR, or mean ∓ threshold·sample deviation.

    A column without spread to measure (no values; one value for z-scores) gets no bounds.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    bounds = {}
    if detector == "iqr":
        for name, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
            if q1 is not None:
                reach = threshold * (q3 - q1)
                bounds[name] = (q1 - reach, q3 + reach)
    elif detector == "zscore":
        for name, s in column_stats(df, columns).items() if columns else ():
            if s["n"] > 1 and s["std"] > 0:
                reach = threshold * s["std"] * (s["n"] / (s["n"] - 1)) ** 0.5
                bounds[name] = (s["mean"] - reach, s["mean"] + reach)
    else:
        raise ValueError(f"unknown detector: {detector}")
    return bounds


def is_outlier(name: str, bounds: Bounds) -> Column:
    low, high = bounds[name]
    x = named(name)
    return F.coalesce(~F.isnan(x.cast("double")) & ((x < low) | (x > high)), F.lit(False))


def count_outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    """``(feature, outliers, percent)`` per column, all columns in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(is_outlier(name, bounds)).alias(f"o{i}") for i, name in enumerate(bounds)],
    )
    entries = [
        F.struct(F.lit(name).alias("feature"), F.col(f"o{i}").alias("outliers")) for i, name in enumerate(bounds)
    ]
    return counted.select("rows", F.inline(F.array(*entries))).select(
        "feature", "outliers", (F.try_divide("outliers", "rows") * 100).alias("percent")
    )


def limit_to_bounds(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Pull values beyond a bound onto it."""
    return replace_columns(df, {name: clip(named(name).cast("double"), *bounds[name]) for name in bounds})


def remove_outlier_rows(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Keep the rows with no outlier in any bounded column."""
    if not bounds:
        return df
    return df.filter(~reduce(or_, [is_outlier(name, bounds) for name in bounds]))


def treat_outliers(
    df: DataFrame,
    detector: str = "iqr",
    action: str = "winsorize",
    threshold: float = 1.5,
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Fit bounds on ``df`` and apply ``action``: ``winsorize``, ``clip`` (the same by name) or ``remove``."""
    actions = {"winsorize": limit_to_bounds, "clip": limit_to_bounds, "remove": remove_outlier_rows}
    if action not in actions:
        raise ValueError(f"unknown action: {action}")
    columns = numeric_columns(df, exclude) if columns is None else columns
    return actions[action](df, fit_bounds(df, detector, threshold, columns))
