"""The fingerprint query. The hash functions have no SQL elsewhere, so it is tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.fingerprints import fingerprints, printed
from rowmill.llm.tables import query, table


@query("op7_scaled_fingerprints")
def scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and likenesses."""
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), printed("sketch").alias("fingerprint"),
        printed("edited").alias("edited_fingerprint"), "near_edited", "near_next", "in_edited", "in_next",
    )
