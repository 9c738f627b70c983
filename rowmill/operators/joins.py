"""Joins that stay safe when the lookup grows or one key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named

BROADCAST_BYTES = 32 << 20
SALTS = 64


def map_values(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    default: Column,
    lookup_bytes: int,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace ``column`` by the looked-up value, unmatched and null keys by ``default``.

    ``lookup`` holds ``(key, value)`` with unique keys. Its known size decides: a small one is broadcast;
    a larger one is joined by shuffle on key plus salt, so that the rows of a hot key are spread over
    ``SALTS`` tasks, against as many copies of the lookup. Salts follow the place of a row in its task, so equal
    rows are spread too.
    """
    small = lookup.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    if lookup_bytes <= broadcast_bytes:
        joined = df.join(F.broadcast(small), named(column) == F.col("_key"), "left")
    else:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        copies = small.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        matches = (named(column) == F.col("_key")) & (F.col("_salt") == F.col("_copy"))
        joined = df.withColumn("_salt", salt).join(copies, matches, "left")
    mapped = F.coalesce(F.col("_value"), default).alias(column)
    return joined.select(*[mapped if c == column else named(c) for c in df.columns])


def align(features: DataFrame, labels: DataFrame, row_id: str) -> DataFrame:
    """Features with the labels of the same row; rows without a partner are left out.

    The id is unique on both sides, so the join cannot skew and Catalyst may pick the strategy.
    """
    return features.join(labels, row_id, "inner")


def attach_group_sizes(means: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two per-group tables on all key columns, null keys equal to each other."""
    right = sizes.withColumnsRenamed({k: f"_{i}" for i, k in enumerate(keys)})
    condition = [named(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return means.join(right, condition, "inner").drop(*[f"_{i}" for i in range(len(keys))])
