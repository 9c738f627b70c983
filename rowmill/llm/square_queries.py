"""The query on periodic runs. SQL cannot express the search; it is tested against brute force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.squares import word_runs
from rowmill.llm.tables import WORD, query, table


def _tail_repeated(text: Column, doc_id: Column) -> Column:
    """In a tenth of the texts, the words from one on repeat with a period; both follow from the id's checksum."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    n = F.size(words)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, period), times)), 1, n - a)
    repeated = F.array_join(F.concat(F.slice(words, 1, a), tail), " ")
    return F.when((h % 10 == 0) & text.rlike(WORD), repeated).otherwise(text)


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the text without the repeated words."""
    docs = table(spark, sf_dir, "documents")
    found = word_runs(docs.select("doc_id", _tail_repeated(F.col("text"), F.col("doc_id")).alias("text")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        (-longest["less"]).alias("length"),
        longest["period"].alias("period"),
        F.floor(-longest["less"] * 1000 / longest["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
