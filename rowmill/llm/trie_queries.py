"""The query on conversation prefixes. SQL is too slow for its subtree sums on whole tables; it is tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.tables import query, table
from rowmill.llm.trie import paths, prefix_trie, shared_beginnings


@query("op11_conversation_trie")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each begun with turns of the first one of its group of five (``%`` cuts towards zero)."""
    conv_id = F.col("conv_id")
    turns = F.crc32(conv_id.cast("string")) % 9
    return prefix_trie(shared_beginnings(paths(table(spark, sf_dir, "conversations")), conv_id - conv_id % 5, turns, 8))
