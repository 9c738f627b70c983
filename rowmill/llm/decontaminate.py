"""Passages of a benchmark in documents, found by spaced seeds and verified word by word.

Every window of ``SPAN`` words is hashed under fixed masks. A mask ignores two of the four residues of the places mod
4, six places in all; the six masks are all such choices. Any two substituted words of a window (and up to six under
one mask) are ignored by some mask, so the window still meets its source. Hashes of documents and benchmark are joined; each hit lines a document up with an item, the words under
the whole window are compared there, and equal places are united along the line. An overlap counts with at least
``LEAST_EQUAL`` equal words. An item shorter than the window is found as a whole: of its n words at least the same share
(``LEAST_EQUAL / SPAN``, rounded up) must be equal, which is all of them up to 5 words and all but one from 6 on. Its own
masks ignore every sixth place, one or two of the item, so any one substituted word is ignored by one of the six. Items
below ``SHORTEST`` words (a single word) name no passage and are left out.

DataFrame functions only. The join broadcasts the benchmark's seeds up to ``BROADCAST_SEEDS`` rows (about 160 bytes
each). Beyond that it sorts and merges, and up to ``BROADCAST_HASHES`` seeds a broadcast of their bare hashes first drops
the windows that meet none, so that only hits are shuffled.

Words are lower-cased runs of anything but white space and punctuation (ASCII and common wide signs); letters of scripts
written without spaces are words of their own. Edge cases: null, empty and blank texts
have no words and no hits; null ids are allowed; rows equal in id and text count once, rows with equal id and other
text separately (their hits are told apart by ``digest``); empty tables give an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.storage import materialize

SPAN = 12
MASKS = tuple(combinations(range(4), 2))  # ignored residues of the place
LEAST_EQUAL = 10
SHORTEST = 2
SHORT_MASKS = 6  # mask r of a short item ignores its places r, r + 6
CHUNK_WORDS = 4096
BROADCAST_SEEDS = 200_000
BROADCAST_HASHES = 2_000_000
# ASCII white space and punctuation, ideographic space, comma and full stop, wide punctuation.
BETWEEN_WORDS = r"[\x09-\x0D\x20!-/:-@\[-`{-~\x{3000}-\x{3002}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}]+"
# Blocks of Thai and Lao, Myanmar, Khmer, kana, and Han with its extensions.
UNSPACED = r"([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])"


def word_hashes(text: Column) -> Column:
    lower = F.lower(text)
    ascii_only = F.octet_length(lower) == F.char_length(lower)
    spaced = F.when(ascii_only, lower).otherwise(F.regexp_replace(lower, UNSPACED, " $1 "))
    words = F.array_remove(F.split(spaced, BETWEEN_WORDS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashed: DataFrame) -> DataFrame:
    """A row per word: its place in the text and the ``SPAN`` words from there as ``w0``, ``w1``, ... (null past the end).

    Long texts are cut into overlapping chunks first, so a row never holds the windows of a whole text.
    """
    others = [c for c in hashed.columns if c != "hashes"]
    starts = F.sequence(F.lit(0), F.size("hashes") - 1, F.lit(CHUNK_WORDS))
    chunks = hashed.where(F.size("hashes") > 0).select(*others, "hashes", F.explode(starts).alias("start"))
    chunks = chunks.select(*others, "start", F.slice("hashes", F.col("start") + 1, F.lit(CHUNK_WORDS + SPAN - 1)).alias("chunk"))
    zipped = F.arrays_zip(*[F.slice("chunk", j + 1, CHUNK_WORDS).alias(f"w{j}") for j in range(SPAN)])
    rows = chunks.select(*others, "start", F.posexplode(zipped).alias("at", "w"))
    return rows.select(*others, (F.col("start") + F.col("at")).alias("place"), *[F.col(f"w.w{j}").alias(f"w{j}") for j in range(SPAN)])


def _seeds(lengths: list[int], least_equal: int) -> Column:
    """Masked hashes of a window; seeds from ``SPAN * n`` on take the first n words, for items of that length."""

    def seed(number: int, last: int, places: list[int]) -> Column:
        masked = F.xxhash64(F.lit(number), *[F.col(f"w{j}") for j in places])
        return F.struct(F.lit(number).alias("seed"), F.when(F.col(f"w{last}").isNotNull(), masked).alias("hash"))

    found = [seed(m, SPAN - 1, [j for j in range(SPAN) if j % 4 not in ignored]) for m, ignored in enumerate(MASKS)]
    for n in lengths:
        exact = n * least_equal > (n - 1) * SPAN
        for r in range(1 if exact else SHORT_MASKS):
            found.append(seed(SPAN * n + r, n - 1, [j for j in range(n) if exact or j % SHORT_MASKS != r]))
    return F.array(*found)


def passages(docs: DataFrame, benchmark: DataFrame, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """One row per document and item that overlap: ``doc_id, digest, item_id, item_words, equal_words, place``.

    Of several overlaps with an item the one with most equal words is given, then the first; ``place`` is the word
    of the document at which the item's first word stands (or would stand).
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("hashes")).withColumn("item_words", F.size("hashes"))
    usable = items.where(F.col("item_words") >= SHORTEST)
    serves = F.floor(F.col("s.seed") / SPAN)  # the item length a seed is for, 0 for the spaced seeds of whole windows
    facts = usable.agg(
        F.sum(F.greatest(F.lit(SHORT_MASKS), (F.col("item_words") - SPAN + 1) * len(MASKS))).alias("seeds"),
        F.collect_set(F.when(F.col("item_words") < SPAN, F.col("item_words"))).alias("short"),
    ).first()
    lengths = sorted(facts["short"] or [])
    own = F.when(F.col("item_words") >= SPAN, serves == 0).otherwise((serves == F.col("item_words")) & (F.col("place") == 0))
    wanted = (
        _windows(usable)
        .select("item_id", "item_words", F.col("place").alias("item_place"), "place", F.array(*[f"w{j}" for j in range(SPAN)]).alias("item_window"), F.explode(_seeds(lengths, least_equal)).alias("s"))
        .where(own & F.col("s.hash").isNotNull())
        .select("item_id", "item_words", "item_place", "item_window", "s.seed", "s.hash")
    )
    seeds = facts["seeds"] or 0
    texts = docs.select("doc_id", F.md5("text").alias("digest"), word_hashes(F.col("text")).alias("hashes"))
    offered = _windows(texts).withColumn("s", F.explode(_seeds(lengths, least_equal))).where(F.col("s.hash").isNotNull())
    offered = offered.select("doc_id", "digest", "place", *[f"w{j}" for j in range(SPAN)], "s.seed", "s.hash")
    if BROADCAST_SEEDS < seeds <= BROADCAST_HASHES:
        wanted = materialize(wanted, "seeds")
        offered = offered.join(F.broadcast(wanted.select("hash").distinct()), "hash", "left_semi")
    wanted = wanted.hint("broadcast" if seeds <= BROADCAST_SEEDS else "merge")
    bits = [F.when(F.col(f"w{j}") == F.get("item_window", F.lit(j)), F.lit(1 << j)).otherwise(0) for j in range(SPAN)]
    equal = bits[0]
    for bit in bits[1:]:
        equal = equal + bit
    hits = offered.join(wanted, ["seed", "hash"]).select("doc_id", "digest", "item_id", "item_words", "item_place", (F.col("place") - F.col("item_place")).alias("line"), equal.alias("equal"))
    # Along a line the windows of one item overlap: an item word is equal or not whatever window shows it.
    places = hits.distinct().select(
        "doc_id", "digest", "item_id", "item_words", "line",
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(SPAN - 1)), lambda j: F.col("equal").bitwiseAND(F.call_function("shiftleft", F.lit(1), j)) != 0)).alias("j"),
        "item_place",
    )
    lines = places.select("doc_id", "digest", "item_id", "item_words", "line", (F.col("item_place") + F.col("j")).alias("word")).distinct()
    counted = lines.groupBy("doc_id", "digest", "item_id", "item_words", "line").agg(F.count("*").alias("equal_words"))
    found = counted.where(F.col("equal_words") >= F.least(F.lit(least_equal), F.ceil(F.col("item_words") * least_equal / SPAN)))
    best = F.max_by(F.struct("equal_words", "line"), F.struct("equal_words", -F.col("line"))).alias("best")
    return (
        found.groupBy("doc_id", "digest", "item_id", "item_words")
        .agg(best)
        .select("doc_id", "digest", "item_id", "item_words", F.col("best.equal_words").alias("equal_words"), F.col("best.line").alias("place"))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """The documents without any overlap, with all their columns."""
    bad = passages(docs, benchmark, least_equal).select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.md5(docs["text"]) == bad["bad_digest"]), "left_anti")
