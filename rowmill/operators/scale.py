"""Scaling fitted on population statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import to_number
from rowmill.functions.text import named
from rowmill.operators.columns import numeric_columns, replace_columns
from rowmill.operators.moments import column_stats
from rowmill.operators.quantiles import exact_quantiles

Scaling = Mapping[str, tuple[float, float]]


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column, a zero deviation replaced by 1."""
    stats = column_stats(df, columns) if columns else {}
    return {name: (s["mean"] or 0.0, s["std"] or 1.0) for name, s in stats.items()}


def fit_robust(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(median, interquartile range) per column, a zero range replaced by 1."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return {name: (mid or 0.0, ((q3 or 0.0) - (q1 or 0.0)) or 1.0) for name, (q1, mid, q3) in quartiles.items()}


def apply_scaling(df: DataFrame, scaling: Scaling) -> DataFrame:
    new = {name: (named(name).cast("double") - F.lit(c)) / F.lit(s) for name, (c, s) in scaling.items()}
    return replace_columns(df, new)


def fill_numbers(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Columns as doubles, gaps and unreadable values replaced by ``value``."""
    return replace_columns(df, {name: F.coalesce(to_number(named(name)), F.lit(value)) for name in columns})


def fit_normalizer(
    df: DataFrame, robust: bool = False, standard: bool = True, exclude: Iterable[str] = ()
) -> tuple[list[str], list[Scaling]]:
    """Columns and the scalings to apply in turn.

    Both statistics are measured on the same input: mean and deviation of a robust-scaled column follow
    from those of the column itself, so the second scaling needs no look at scaled data.
    """
    columns = numeric_columns(df, exclude)
    filled = fill_numbers(df, columns)
    steps: list[Scaling] = []
    if robust:
        steps.append(fit_robust(filled, columns))
    if standard:
        raw = fit_standard(filled, columns)
        before = steps[0] if steps else {name: (0.0, 1.0) for name in columns}
        steps.append(
            {
                name: ((mean - before[name][0]) / before[name][1], std / before[name][1])
                for name, (mean, std) in raw.items()
            }
        )
    return columns, steps


def normalize(df: DataFrame, columns: Sequence[str], steps: Sequence[Scaling]) -> DataFrame:
    """Apply a fitted normaliser; booleans and text stay as they are."""
    df = fill_numbers(df, columns)
    for scaling in steps:
        df = apply_scaling(df, scaling)
    return df
