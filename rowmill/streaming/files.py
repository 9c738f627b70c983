"""Feature extraction over files as they arrive.

The row-by-row steps (cleaning, currency, features, fitted fills and scalings) hold no state, so the
same functions that serve a batch table serve a stream. Anything that has to see all rows is fitted on
a batch table first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowmill.operators.columns import Stage, run_stages
from rowmill.sources.csv import NULL_TEXTS, null_out
from rowmill.storage import new_path


def csv_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 1000, multi_line: bool = True
) -> DataFrame:
    """Files as they arrive, each read by one task so that quoted line breaks are kept; without ``multi_line`` they are split."""
    reader = spark.readStream.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"')
    return null_out(reader.option("maxFilesPerTrigger", files_per_batch).csv(path), NULL_TEXTS)


def append_features(stream: DataFrame, stages: Sequence[Stage], path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append transformed rows to Parquet until the files present now are done."""
    location = checkpoint or new_path(stream.sparkSession, "stream")
    writer = run_stages(stream, stages).writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", location).trigger(availableNow=True).start(path)
