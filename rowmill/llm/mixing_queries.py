"""The mixing query and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm.mixing import BLOCK_WORDS, SEED, SHARD_WORDS, mix
from rowmill.llm.tables import query, table

# Seats are listed one by one here: the plain definition of highest quotients.
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_docs,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT]::BIGINT AS weight FROM by_source
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)
    / sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), reached AS (
  SELECT *, max(CASE WHEN 2.0::DOUBLE * source_size >= weight * level THEN level END) OVER () AS reach FROM levels
), targets AS (
  SELECT source, place, source_size, source_docs,
    least(2.0::DOUBLE * source_size, coalesce(weight * reach, 2.0::DOUBLE * source_size)) AS target FROM reached
), seats AS (SELECT round(sum(target) / {BLOCK_WORDS})::BIGINT AS n FROM targets),
source_quotients AS (
  SELECT place, target / (2 * k + 1) AS quotient
  FROM targets, LATERAL (SELECT unnest(range(0, 2 + ceil(2.5 * source_size / {BLOCK_WORDS})::BIGINT)) AS k)
), source_quota AS (
  SELECT place, count(*) AS seats FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, place) AS nth FROM source_quotients)
  WHERE nth <= (SELECT n FROM seats) AND quotient > 0 GROUP BY place
), dealt AS (
  SELECT s.*, place, source_size, target,
    ('0x' || substr(md5(concat_ws('|', '{SEED}', doc_id, digest)), 1, 8))::BIGINT
      % greatest(ceil((source_size + source_docs * 16) / {SHARD_WORDS})::BIGINT, 1) AS shard,
    md5(concat_ws('|', '{SEED}', 'order', doc_id, digest)) AS drawn
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), shard_sizes AS (
  SELECT place, shard, sum(size)::BIGINT AS words FROM dealt GROUP BY ALL
), shard_quotients AS (
  SELECT place, shard, words, words / (2 * k + 1)::DOUBLE AS quotient
  FROM shard_sizes, LATERAL (SELECT unnest(range(0, 2 + ceil(2.5 * words / {BLOCK_WORDS})::BIGINT)) AS k)
), shard_quota AS (
  SELECT q.place, shard, any_value(words) AS words, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY quotient DESC, shard) AS nth FROM shard_quotients) q
  JOIN source_quota s ON q.place = s.place WHERE nth <= seats AND quotient > 0 GROUP BY q.place, shard
), shards AS (
  SELECT place, shard, words, greatest(round(words / {BLOCK_WORDS}::DOUBLE)::BIGINT, 1) AS blocks,
    least(quota, 2 * greatest(round(words / {BLOCK_WORDS}::DOUBLE)::BIGINT, 1)) AS quota FROM shard_quota
), blocks AS (
  SELECT *, quota // blocks + CASE WHEN row_number() OVER (PARTITION BY place, shard
      ORDER BY md5(concat_ws('|', '{SEED}', place, shard, block)), block) <= quota % blocks THEN 1 ELSE 0 END AS times
  FROM (SELECT *, unnest(range(0, blocks)) AS block FROM shards)
), placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY place, shard ORDER BY drawn, doc_id, size, digest
    ROWS UNBOUNDED PRECEDING))::BIGINT AS e, row_number() OVER () AS id FROM dealt
), pieces AS (
  SELECT id, p.place, p.shard, e, e - size AS b, words, blocks,
    unnest(range(((e - size + 1) * blocks - 1) // words, (e * blocks - 1) // words + 1)) AS block
  FROM placed p JOIN shards s ON p.place = s.place AND p.shard = s.shard WHERE size > 0
), taken AS (
  SELECT id, sum((least(e, (p.block + 1) * p.words // p.blocks) - greatest(b, p.block * p.words // p.blocks)) * times)::BIGINT AS taken
  FROM pieces p JOIN blocks k ON p.place = k.place AND p.shard = k.shard AND p.block = k.block GROUP BY id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN taken USING (id)
"""


@query("op1_mix_sources", MIX_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
