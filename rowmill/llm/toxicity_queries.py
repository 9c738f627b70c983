"""The toxicity query. A fitted model has no SQL; it is tested for held-out accuracy and against plain matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.tables import query, table
from rowmill.llm.toxicity import fit_toxicity, held_out, sample_labelled, toxicity


@query("op8_toxicity_lexicon")
def toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity(docs, fit_toxicity(sample_labelled(docs, labels)))
    return scored.select(F.col("kept").alias("doc_id"), held_out(F.col("kept")).alias("held_out"), "score", "predicted")
