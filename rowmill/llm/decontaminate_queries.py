"""The benchmark query and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.decontaminate import BETWEEN_WORDS, LEAST_EQUAL, MASKS, SHORTEST, SPAN, UNSPACED, passages
from rowmill.llm.tables import query, table

_MASKED = " || ' ' || ".join(f"CASE WHEN {j % 4} IN (one, other) THEN '' ELSE w[p + {j}] END" for j in range(SPAN))
_WORDS = f"list_filter(regexp_split_to_array(regexp_replace(lower(text), '{UNSPACED}', ' \\1 ', 'g'), '{BETWEEN_WORDS}'), lambda x: x <> '')"
PASSAGES_SQL = f"""
WITH doc_words AS (
  SELECT doc_id, md5(text) AS digest, {_WORDS} AS w FROM documents
), item_words AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), masks AS (SELECT * FROM (VALUES {', '.join(map(str, MASKS))}) AS v(one, other)),
doc_seeds AS (
  SELECT doc_id, digest, p, one, other, {_MASKED} AS masked
  FROM (SELECT *, unnest(range(1, len(w) - {SPAN} + 2)) AS p FROM doc_words), masks
), item_seeds AS (
  SELECT item_id, p, one, other, {_MASKED} AS masked
  FROM (SELECT *, unnest(range(1, len(w) - {SPAN} + 2)) AS p FROM item_words), masks
), long_hits AS (
  SELECT DISTINCT d.doc_id, d.digest, i.item_id, d.p AS p, i.p AS q, {SPAN} AS n
  FROM doc_seeds d JOIN item_seeds i ON d.one = i.one AND d.other = i.other AND d.masked = i.masked
), short_items AS (
  SELECT item_id, w, len(w) AS n, ceil(len(w) * {LEAST_EQUAL} / {SPAN}) AS least FROM item_words WHERE len(w) >= {SHORTEST} AND len(w) < {SPAN}
), short_hits AS (
  SELECT d.doc_id, d.digest, s.item_id, d.p, 1 AS q, s.n
  FROM short_items s JOIN (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM doc_words) d ON d.p + s.n - 1 <= len(d.w)
  WHERE len(list_filter(range(1, s.n + 1), lambda j: d.w[d.p + j - 1] = s.w[j])) >= s.least
), hits AS (SELECT * FROM long_hits UNION ALL SELECT * FROM short_hits),
words AS (
  SELECT DISTINCT h.doc_id, h.digest, h.item_id, len(i.w) AS item_words, h.p - h.q AS line, h.q + j AS word
  FROM hits h, LATERAL (SELECT unnest(range(0, h.n)) AS j), doc_words d, item_words i
  WHERE h.doc_id = d.doc_id AND h.digest = d.digest AND h.item_id = i.item_id AND d.w[h.p + j] = i.w[h.q + j]
), lines AS (
  SELECT doc_id, digest, item_id, item_words, line, count(*) AS equal_words FROM words GROUP BY ALL
  HAVING count(*) >= least({LEAST_EQUAL}, ceil(item_words * {LEAST_EQUAL} / {SPAN}))
)
SELECT doc_id, item_id, item_words::INT AS item_words, equal_words, line::INT AS place FROM lines
QUALIFY row_number() OVER (PARTITION BY doc_id, digest, item_id ORDER BY equal_words DESC, line) = 1
"""


@query("op10_benchmark_decontamination", PASSAGES_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item and the size of the overlap."""
    found = passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "equal_words", "place")
