"""Feature matrix and target on disk: one Parquet table with a column per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.columns import reconcile_names


def write_matrix(df: DataFrame, path: str, features: Sequence[str], target: str, row_id: str | None = None) -> int:
    """Write the table, and return the rows that went into it, counted by the tasks that write them."""
    keys = [named(row_id)] if row_id else []
    numbers = [named(c).cast("double").alias(c) for c in [*features, target]]
    sent = Observation()
    df.select(*keys, *numbers).observe(sent, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(sent.get.get("rows") or 0)


def read_matrix(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """Read a matrix; ``names`` (cut or filled up to the table's width) replace the stored ones."""
    df = spark.read.parquet(path)
    return df if names is None else df.toDF(*reconcile_names(names, len(df.columns)))


def verify_written(spark: SparkSession, path: str, columns: Sequence[str], rows: int) -> DataFrame:
    """Re-read what was written and compare width, names and row count; one row."""
    written = spark.read.parquet(path)
    return written.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(written.columns)).alias("columns"),
        (F.col("rows") == rows).alias("rows_match"),
        F.lit(list(written.columns) == list(columns)).alias("columns_match"),
    )
