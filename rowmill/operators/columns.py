"""Choosing, renaming and reshaping columns (plan-time work on the schema)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.numeric import text_to_number, to_number
from rowmill.functions.text import named

Stage = Callable[[DataFrame], DataFrame]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns; booleans do not count as numbers."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def unique(names: Iterable[str]) -> list[str]:
    """Names without repeats, in first-seen order."""
    return list(dict.fromkeys(names))


def first_present(df: DataFrame, aliases: Sequence[str]) -> str | None:
    present = set(df.columns)
    return next((name for name in aliases if name in present), None)


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add or overwrite columns in one projection."""
    return df.withColumns(new) if new else df


def append_columns(df: DataFrame, other: dict[str, Column]) -> DataFrame:
    """Horizontal concat: computed columns after the existing ones; a repeated name is an error."""
    clash = [name for name in other if name in df.columns]
    if clash:
        raise ValueError(f"columns already present: {clash}")
    return replace_columns(df, other)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Vertical concat by column name; a column absent from one input is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def coerce_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Read columns as doubles, unreadable values as null."""
    columns = df.columns if columns is None else columns
    texts = set(text_columns(df))
    return replace_columns(df, {c: (text_to_number if c in texts else to_number)(named(c)) for c in columns})


def project_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Only ``names`` (and ``keep``); a table that is already that narrow passes unchanged."""
    wanted = unique([*keep, *names])
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")
    return df if df.columns == wanted else df.select(*map(named, wanted))


def split_target(df: DataFrame, target: str, ignore: Iterable[str] = ()) -> tuple[list[str], str]:
    """Feature names and target name; a missing target is an error when the plan is built."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found; available: {df.columns}")
    skip = {target, *ignore}
    return [name for name in df.columns if name not in skip], target


def reconcile_names(names: Sequence[str], width: int) -> list[str]:
    """Exactly ``width`` names: cut surplus ones, fill up with ``feature_<position>``."""
    kept = list(names[:width])
    return kept + [f"feature_{position}" for position in range(len(kept), width)]


def assign(df: DataFrame, mask: Column, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` where ``mask`` holds."""
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(mask, value).otherwise(named(column)))


def run_stages(df: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """Apply stages in order. A user stage is any function from DataFrame to DataFrame."""
    for stage in stages:
        df = df.transform(stage)
    return df
