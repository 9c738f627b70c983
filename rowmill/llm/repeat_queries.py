"""The query on repeated byte strings. SQL is too slow on whole texts; it is tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.repeats import repeated_bytes
from rowmill.llm.tables import query, table


@query("op5_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and a digest of what is left."""
    return repeated_bytes(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
