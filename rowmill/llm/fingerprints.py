"""Document fingerprints: threshold-scaled sketches of word shingles, with DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the document and the
sketches of two documents agree on what they keep: containment between very unequal documents can be estimated, and
sketches merge. Below ``LEAST`` such hashes the smallest ``LEAST`` are kept; texts with no more shingles than that
are compared exactly. Two sketches are compared below the smaller of the limits up to which each is complete.

Edge cases: a null text is an empty one; a text without words has an empty sketch, which is like another empty one
(1) and unlike all others (0); fewer than five words make one shingle of the whole sequence; null ids come last in
descending order (the id -2^63 counts as null); rows equal in id and text count once in that order and each get a row; equal ids with different
texts are ordered by a hash of the text; a single document follows itself; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.tables import SPACES
from rowmill.storage import materialize

K = 5
FRACTION = 8  # one hash in so many is kept
LEAST = 48
_LOWEST = -(1 << 63)
_END = (1 << 63) - 1


def with_sketch(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Add the sketch of a text column: sorted hashes, as ``array<long>``."""
    words = F.array_remove(F.split(F.lower(F.col(text)), SPACES), "")
    hashed = frame.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    at = lambda i: F.get("_words", i)
    runs = F.transform(F.slice("_words", F.lit(1), F.size("_words") - (K - 1)), lambda _, i: F.xxhash64(*[at(i + j) for j in range(K)]))
    whole = F.array(F.xxhash64("_words"))
    shingles = F.when(F.size("_words") >= K, runs).when(F.size("_words") > 0, whole).otherwise(F.array().cast("array<bigint>"))
    limit = F.lit(_LOWEST + (1 << 64) // FRACTION)
    return (
        hashed.withColumn("_sorted", F.sort_array(F.array_distinct(shingles)))
        .withColumn(name, F.slice("_sorted", F.lit(1), F.greatest(F.size(F.filter("_sorted", lambda h: h < limit)), F.least(F.lit(LEAST), F.size("_sorted")))))
        .withColumn(f"{name}_limit", F.when(F.size(name) == F.size("_sorted"), F.lit(_END)).otherwise(F.greatest(limit, F.element_at(name, -1) + 1)))
        .drop("_words", "_sorted")
    )


def shared_below(one: str, other: str) -> tuple[Column, Column, Column]:
    """Hashes in both sketches and in each, below the limit to which both are complete."""
    limit = F.least(f"{one}_limit", f"{other}_limit")
    below = lambda c: F.filter(c, lambda h: (h < limit) | (limit == _END))
    return F.size(F.array_intersect(below(one), below(other))), F.size(below(one)), F.size(below(other))


def likeness(one: str, other: str) -> Column:
    """Estimated share of common shingles among all shingles of two sketch columns (Jaccard)."""
    both, n, m = shared_below(one, other)
    return F.when(F.col(one) == F.col(other), 1.0).when(n + m == 0, 0.0).otherwise(both / (n + m - both))


def containment(one: str, other: str) -> Column:
    """Estimated share of the first one's shingles that the other has."""
    both, n, _ = shared_below(one, other)
    return F.when(F.col(one) == F.col(other), 1.0).when(n == 0, 0.0).otherwise(both / n)


def merged(one: str, other: str) -> tuple[Column, Column]:
    """Sketch and limit of two documents together."""
    limit = F.least(f"{one}_limit", f"{other}_limit")
    return F.sort_array(F.filter(F.array_union(one, other), lambda h: (h < limit) | (limit == _END))), limit


def printed(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.hex(h)), ".")


def _followers(rows: DataFrame) -> tuple[DataFrame, bool]:
    """For each document (``id, key``) the one that it follows in descending id order: ``of_id, of_key, of_chars``.

    The order is made by range partitions: numbers inside each, plus the rows of the partitions before it.
    """
    known = materialize(rows.select("id", "key", F.length("text").cast("long").alias("n_chars")), "fingerprint-ids")
    distinct = known.distinct()
    by = [F.col("id").desc(), F.col("key")]
    ordered = materialize(distinct.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "fingerprint-order")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = ordered.join(sizes.select("part", before.alias("before")), part == F.col("part")).withColumn("number", F.col("before") + F.col("at") - F.shiftleft("part", 33))
    n = max(ordered.count(), 1)
    follows = numbered.select("id", "key", F.pmod(F.col("number") - 1, F.lit(n)).alias("number"))
    ahead = numbered.select("number", F.col("id").alias("of_id"), F.col("key").alias("of_key"), F.col("n_chars").alias("of_chars"))
    return materialize(follows.join(ahead, "number").drop("number"), "fingerprint-followers"), known.count() > n


def fingerprints(docs: DataFrame) -> DataFrame:
    """Sketches of every document, of its edited text and of the next document, with their likenesses.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many of the next
    document in descending id order (the first after the last).
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Both uses of the sketched texts below need the same columns, so that their shuffle is done once.
    keyed = whole.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("key"), "text")
    followers, repeats = _followers(keyed)
    placed = with_sketch(keyed, "text", "sketch").join(followers.hint("merge"), ["id", "key"])
    given = placed.select(
        F.col("of_id").alias("id"), F.col("of_key").alias("key"),
        F.substring("text", F.lit(1), F.floor(F.col("of_chars") / 2).cast("int")).alias("given"),
        F.col("sketch").alias("next"), F.col("sketch_limit").alias("next_limit"),
    )
    if repeats:
        given = given.dropDuplicates(["id", "key"])
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.col("given"))
    both = (
        placed.join(given.hint("merge"), ["id", "key"])
        .withColumn("edited_text", edited)
        .withColumn("doc_id", F.nullif("id", F.lit(_LOWEST)))
        .withColumn("n_chars", n_chars.cast("long"))
    )
    return with_sketch(both, "edited_text", "edited").select(
        "doc_id", "n_chars", "edited_text", "sketch", "sketch_limit", "edited", "edited_limit", "next", "next_limit",
        likeness("sketch", "edited").alias("near_edited"), likeness("sketch", "next").alias("near_next"),
        containment("sketch", "edited").alias("in_edited"), containment("sketch", "next").alias("in_next"),
    )
