"""The queries on tokens. Tokenizers have no SQL; both are tested against whole-text encoding and a round trip."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.repair import read_token_files, write_token_files
from rowmill.llm.tables import query, table
from rowmill.llm.tokens import token_counts
from rowmill.storage import new_path

CONTEXT = 2048


@query("op2_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the written files."""
    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


@query("op3_token_counts")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)
