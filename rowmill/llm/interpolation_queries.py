"""The query on language-model scores. SQL cannot express the fit; it is tested against brute force and for its total probability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.interpolation import interpolated_scores
from rowmill.llm.tables import query, table


@query("op13_interpolated_scores")
def interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of nine tenths of them; null ids are learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    scores = interpolated_scores(docs, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
