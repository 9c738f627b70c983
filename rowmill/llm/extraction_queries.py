"""The extraction query. A parser has no SQL; it is tested on pages with known main texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.extraction import main_texts
from rowmill.llm.tables import query, table


@query("op6_consensus_extraction")
def consensus_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(table(spark, sf_dir, "pages"))
