"""The near-duplicate query. Exact components need a graph search, so it is tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.near_duplicates import near_duplicates
from rowmill.llm.tables import query, table


@query("op9_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of similarity 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
