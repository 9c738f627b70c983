"""Exact duplicates and duplicate feature rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named


def drop_duplicate_rows(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """One row per distinct record, nulls equal to each other.

    With ``row_id``, the record is all other columns and the smallest id is kept. Either way copies are
    merged before the shuffle, so a record that makes up much of the table does not weigh on one task.
    """
    if row_id is None:
        return df.dropDuplicates()
    record = [named(c) for c in df.columns if c != row_id]
    merged = df.groupBy(*record).agg(F.min(named(row_id)).alias(row_id))
    return merged.select(*map(named, df.columns))


def merge_duplicate_features(
    df: DataFrame,
    target: str,
    keys: Sequence[str] | None = None,
    ignore: Iterable[str] = (),
    row_id: str | None = None,
    drop_null_keys: bool = False,
    size_column: str | None = None,
    sort: bool = False,
) -> DataFrame:
    """Average ``target`` over rows with equal features; mean and group size come from one aggregate.

    ``keys`` default to every column but the target, ``row_id`` and the ``ignore`` ones (identifiers
    would keep any rows from merging). The smallest ``row_id`` stands for the merged row.
    """
    skip = {target, row_id, *ignore}
    keys = list(keys) if keys is not None else [c for c in df.columns if c not in skip]
    if drop_null_keys:
        df = df.dropna(subset=keys)
    measures = [F.avg(named(target)).alias(target)]
    if row_id is not None:
        measures.insert(0, F.min(named(row_id)).alias(row_id))
    if size_column is not None:
        measures.append(F.count(F.lit(1)).alias(size_column))
    merged = df.groupBy(*map(named, keys)).agg(*measures)
    return merged.orderBy(*map(named, keys)) if sort else merged


def reduction_report(merged: DataFrame, size_column: str) -> DataFrame:
    """One row: rows before and after merging, rows saved, mean group size."""
    size = named(size_column)
    return merged.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.coalesce(F.sum(size), F.lit(0)) - F.count(F.lit(1))).alias("rows_saved"),
        F.avg(size).alias("mean_group_size"),
    )


def distinct_combinations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of distinct key combinations, a null counting as a value."""
    return df.select(*map(named, keys)).distinct().agg(F.count(F.lit(1)).alias("combinations"))
