"""Filling gaps with column statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.columns import coerce_numeric, numeric_columns, replace_columns, text_columns
from rowmill.operators.quantiles import medians


SURVIVORS, TRACKED = 64, 8192  # values per column that are counted exactly, and kept in a task


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(position, value, rows)`` per distinct text value, nulls included, all columns in one shuffle."""
    cells = F.array(
        *[F.struct(F.lit(i).alias("position"), named(c).alias("value")) for i, c in enumerate(columns)]
    )
    return df.select(F.inline(cells)).groupBy("position", "value").agg(F.count(F.lit(1)).alias("rows"))


def modes(df: DataFrame, columns: Sequence[str], default: str) -> dict[str, str]:
    """Most frequent value per text column, ties to the smallest; ``default`` if there is no value.

    A mergeable frequent-items summary per column keeps ``TRACKED`` values in a task, and only these summaries are shuffled. The
    ``SURVIVORS`` it ranks first are counted exactly. The best of them is the mode for certain if its count is above what any other
    value can have: twice the summary's error (below 4 rows of ``TRACKED``), and its estimate of the last survivor. Columns without such a value,
    as those of keys where no value stands out, are counted in full: every distinct value goes through a shuffle in parallel groups.
    """
    if not columns:
        return {}
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(named(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.call_function("approx_top_k", named(c).cast("string"), F.lit(SURVIVORS), F.lit(TRACKED)).alias(f"t{i}") for i, c in enumerate(columns)],
    ).first()
    survivors = {c: [item for item, _ in row[f"t{i}"] if item is not None] for i, c in enumerate(columns)}
    found = _most_frequent(df, {c: values for c, values in survivors.items() if values})
    sure = {}
    for i, c in enumerate(columns):
        listed = row[f"t{i}"]
        others = max(8 * row["rows"] / TRACKED, listed[-1][1] if len(listed) == SURVIVORS else 0)
        if c in found and found[c][1] > others:
            sure[c] = found[c][0]
    open_columns = [c for c in columns if c not in sure and row[f"n{columns.index(c)}"]]
    if open_columns:
        sure |= {c: value for c, (value, _) in _most_frequent(df, {c: None for c in open_columns}).items()}
    return {name: sure.get(name, default) for name in columns}


def _most_frequent(df: DataFrame, among: Mapping[str, Sequence[str] | None]) -> dict[str, tuple[str, int]]:
    """Most frequent value and its rows per column, among the given values (or all)."""
    if not among:
        return {}
    columns = [f"c{i}" for i in range(len(among))]
    cells = [named(c) if values is None else F.when(named(c).isin(list(values)), named(c)) for c, values in among.items()]
    counts = value_counts(df.select(*[cell.alias(c) for cell, c in zip(cells, columns)]), columns).where("value IS NOT NULL")
    top = counts.groupBy("position").agg(F.min_by(F.struct("value", "rows"), F.struct(-F.col("rows"), "value")).alias("best"))
    return {list(among)[r["position"]]: (r["best"]["value"], r["best"]["rows"]) for r in top.collect()}


def fit_medians(df: DataFrame, exclude: Iterable[str] = ()) -> dict[str, float]:
    fills = medians(df, numeric_columns(df, exclude))
    return {name: value for name, value in fills.items() if value is not None}


def fit_modes(df: DataFrame, default: str, exclude: Iterable[str] = ()) -> dict[str, str]:
    return modes(df, text_columns(df, exclude), default)


def fill_missing(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Replace null (and NaN) per column. Numbers come out as doubles: a median may be fractional."""
    new = {}
    for name, value in fills.items():
        if isinstance(value, str):
            new[name] = F.coalesce(named(name), F.lit(value))
        else:
            x = named(name).cast("double")
            new[name] = F.coalesce(F.when(~F.isnan(x), x), F.lit(float(value)))
    return replace_columns(df, new)


def prepare_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, gaps and unreadable values filled with the column median."""
    numbers = coerce_numeric(df, features)
    if not features:
        return numbers
    gaps = numbers.agg(*[F.count_if(named(c).isNull()).alias(f"g{i}") for i, c in enumerate(features)]).first()
    fills = medians(numbers, [c for c, missing in zip(features, gaps) if missing])
    return fill_missing(numbers, {name: value for name, value in fills.items() if value is not None})
