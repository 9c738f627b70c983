"""Names and types of features, kept beside the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.columns import reconcile_names


def feature_metadata(df: DataFrame) -> DataFrame:
    """``(position, name, dtype, feature_count, row_count)``, one row per column."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.lit(kind).alias("dtype"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("row_count", F.inline(F.array(*entries))).select(
        "position", "name", "dtype", F.lit(len(df.columns)).alias("feature_count"), "row_count"
    )


def write_feature_metadata(df: DataFrame, path: str) -> None:
    feature_metadata(df).coalesce(1).write.mode("overwrite").json(path)


def write_feature_names(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """Names as JSON rows under ``<path>/json`` and as ``position: name`` lines under ``<path>/text``."""
    rows = spark.createDataFrame(list(enumerate(names)), "position int, name string").coalesce(1)
    rows.write.mode("overwrite").json(f"{path}/json")
    rows.orderBy("position").select(F.concat_ws(": ", "position", "name").alias("line")).write.mode("overwrite").text(
        f"{path}/text"
    )


def read_feature_names(spark: SparkSession, paths: Sequence[str], width: int) -> list[str]:
    """Names from the first path that exists, JSON or text form, brought to ``width``; without any,
    ``feature_<position>``."""
    for path in paths:
        for form in (f"{path}/text", f"{path}/json", path):
            names = _names_at(spark, form)
            if names:
                return reconcile_names(names, width)
    return reconcile_names([], width)


def _names_at(spark: SparkSession, path: str) -> list[str]:
    try:
        lines = [row["value"] for row in spark.read.text(path).collect()]  # one line per feature
    except AnalysisException:
        return []
    if lines and lines[0].startswith("{"):
        rows = spark.read.schema("position int, name string").json(path).orderBy("position").collect()
        return [row["name"] for row in rows if row["name"] is not None]
    numbered = [line.split(": ", 1) for line in lines if ": " in line]
    return [name for _, name in sorted(numbered, key=lambda part: int(part[0]))]
