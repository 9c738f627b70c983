"""Mix sources to target weights: Sainte-Laguë quotas of equal blocks, then seeded selection of blocks.

Every source gets a target number of words. Documents are dealt to shards, each shard is one stream of words cut
into equal blocks of about ``block_words``. Seats (blocks) go to sources, and within a source to its shards, by the highest
quotients ``target / 1, 3, 5, ...``; a shard then takes whole passes over its blocks plus the blocks with the
smallest seeded hashes. Documents are dealt by id and text together, so null or repeated ids spread over all shards of
their source; only rows equal in both stay in one.

Edge cases: null and empty texts have size 0 and are never taken; a null source is a source of its own, last in
order; null ids are allowed; repeated rows are separate documents; an empty table gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.tables import WORD
from rowmill.storage import materialize

BLOCK_WORDS = 128
SHARD_WORDS = 1 << 20
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _seeded(*parts: Column | str) -> Column:
    """Hex digest of the parts; equal on every run and engine."""
    return F.md5(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: its place, words, documents and target.

    Targets are in proportion to the weights, but at most ``most`` times the source's words; what is cut is dealt
    to the others by weight. In the order of words per weight the cut sources come first, so the level all others
    reach follows from running sums; from the first one that is not cut, the running level only falls.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
        .withColumn("place", F.row_number().over(every))
        .withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long"))
    )
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "place")
    up_to = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    cap = (F.col("source_size") * most).cast("double")
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("source_size").over(up_to), F.lit(0)) * most) / F.sum("weight").over(rest)
    return (
        ranked.withColumn("level", level)
        .withColumn("reached", F.max(F.when(cap >= F.col("weight") * F.col("level"), F.col("level"))).over(whole))
        .withColumn("target", F.least(cap, F.coalesce(F.col("weight") * F.col("reached"), cap)))
        .select("source", "place", "source_size", "source_docs", "target")
    )


def apportion(claims: DataFrame, group: Sequence[str], tie: Sequence[str], claim: str, seats: str) -> DataFrame:
    """Add ``quota``: the seats of each group dealt to its rows by the highest quotients claim / 1, 3, 5, ...

    No list of all seats is made. The final divisor lies between total / (seats + n / 2) and total / (seats - n / 2)
    for n rows, which leaves a row all but a few of its seats as certain; only the open ones are ranked.
    """
    of = Window.partitionBy(*group)
    total, rows, n = F.sum(F.col(claim).cast("double")).over(of), F.count("*").over(of), F.col(seats)
    bounded = (
        claims.withColumn("total", total)
        .withColumn("rows", rows)
        .withColumn("sure", F.when((n * 2 > F.col("rows")) & (F.col("total") > 0), F.ceil(F.col(claim) * (n - F.col("rows") / 2) / F.col("total") - 0.5) - 1))
        .withColumn("sure", F.greatest(F.coalesce("sure", F.lit(0)), F.lit(0)).cast("long"))
        .withColumn("most", F.when(F.col("total") > 0, F.floor(F.col(claim) * (n + F.col("rows") / 2) / F.col("total") + 0.5) + 1))
        .withColumn("most", F.greatest(F.coalesce("most", F.lit(0)), F.col("sure")).cast("long"))
        .withColumn("open", n - F.sum("sure").over(of))
    )
    best = Window.partitionBy(*group).orderBy(F.desc("quotient"), *tie)
    key = [*dict.fromkeys([*group, *tie])]
    won = (
        bounded.where(F.col("most") > F.col("sure"))
        .select(*key, claim, "open", F.explode(F.sequence(F.col("sure"), F.col("most") - 1)).alias("_seat"))
        .withColumn("quotient", F.col(claim) / (F.col("_seat") * 2 + 1))
        .withColumn("nth", F.row_number().over(best))
        .where((F.col("nth") <= F.col("open")) & (F.col("quotient") > 0))
        .groupBy(*key)
        .agg(F.count("*").alias("won"))
    )
    return bounded.join(won, key, "left").withColumn("quota", F.col("sure") + F.coalesce("won", F.lit(0))).drop("total", "rows", "sure", "most", "open", "won")


def _sized(docs: DataFrame, keep_text: bool) -> DataFrame:
    text = F.col("text")
    columns = [F.col("doc_id"), F.col("source"), word_count(text).alias("size"), F.md5(text).alias("digest")]
    return docs.select(*columns, *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_text else []))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, shard, taken, spans``.

    ``spans`` holds the word ranges (``first``, ``words``, ``times``) that the mix takes, ``taken`` their total
    with repeats. ``keep_text`` adds the whole input row as ``row``. Only counts are shuffled otherwise.
    """
    sizes = _sized(docs, keep_text)
    if not keep_text:
        sizes = materialize(sizes, "mix-sizes")
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long")
    targets = source_targets(sizes.select("source", "size"), weights, share, most).withColumn("seats", seats)
    sources = materialize(
        apportion(targets, [], ["place"], "target", "seats")
        .withColumn("shards", F.greatest(F.ceil((F.col("source_size") + F.col("source_docs") * 16) / shard_words), F.lit(1)).cast("long"))
        .withColumnRenamed("source", "of_source"),
        "mix-sources",
    )
    deal = F.conv(F.substring(_seeded(seed, F.col("doc_id"), F.col("digest")), 1, 8), 16, 10).cast("long")
    dealt = sizes.join(sources, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("shard", deal % F.col("shards"))
    shard_sizes = dealt.groupBy("place", "shard", F.col("quota").alias("seats")).agg(F.sum("size").alias("words"))
    shards = materialize(
        apportion(shard_sizes, ["place"], ["shard"], "words", "seats")
        .where(F.col("words") > 0)
        .withColumn("blocks", F.greatest(F.round(F.col("words") / block_words), F.lit(1)).cast("long"))
        .withColumn("quota", F.least("quota", F.col("blocks") * most))
        .select("place", "shard", "words", "blocks", "quota"),
        "mix-shards",
    )
    draw = Window.partitionBy("place", "shard").orderBy(_seeded(seed, F.col("place"), F.col("shard"), F.col("block")), "block")
    blocks = (
        shards.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("extra", (F.row_number().over(draw) <= F.col("quota") % F.col("blocks")).cast("long"))
        .select("place", "shard", "block", (F.floor(F.col("quota") / F.col("blocks")) + F.col("extra")).alias("times"))
        .where("times > 0")
    )
    stream = Window.partitionBy("place", "shard").orderBy("drawn", "doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.withColumn("drawn", _seeded(seed, "order", F.col("doc_id"), F.col("digest")))
        .withColumn("end", F.sum("size").over(stream))
        .withColumn("begin", F.col("end") - F.col("size"))
        .withColumn("spot", F.when(F.col("size") > 0, F.col("end")))  # unique in the shard
    )
    # Block b of a shard holds the words from floor(b * words / blocks) on: all blocks are equal but for one word.
    edge = lambda b: F.floor(b * F.col("words") / F.col("blocks"))
    block_of = lambda word: F.floor(((word + 1) * F.col("blocks") - 1) / F.col("words"))
    first, last = F.greatest("begin", "block_begin"), F.least("end", "block_end")
    pieces = (
        placed.where("size > 0")
        .select("place", "shard", "begin", "end")
        .join(shards.select("place", "shard", "words", "blocks").hint("merge"), ["place", "shard"])
        .withColumn("block", F.explode(F.sequence(block_of(F.col("begin")), block_of(F.col("end") - 1))))
        .select("place", "shard", "begin", "end", "block", edge(F.col("block")).alias("block_begin"), edge(F.col("block") + 1).alias("block_end"))
    )
    taken = (
        pieces.join(blocks.hint("merge"), ["place", "shard", "block"])  # sizes of exploded rows are underestimated
        .groupBy("place", "shard", F.col("end").alias("spot"))
        .agg(
            F.sum((last - first) * F.col("times")).alias("taken"),
            F.array_sort(F.collect_list(F.struct((first - F.col("begin")).alias("first"), (last - first).alias("words"), "times"))).alias("spans"),
        )
    )
    return placed.join(taken, ["place", "shard", "spot"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "shard", F.coalesce("taken", F.lit(0)).alias("taken"), "spans", *(["row"] if keep_text else []),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: for each pass over a document one row with the words that the pass takes.

    A row keeps all columns of its document; ``text`` is the taken words with the white space behind each, and
    ``n_chars`` (if there is one) its code points. A document of which nothing is taken has no row.
    """
    mixed = mix(docs, keep_text=True, **options)
    passes = F.sequence(F.lit(1), F.array_max(F.transform("spans", lambda s: s["times"])).cast("int"))
    words = F.regexp_extract_all("row.text", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    of_pass = F.filter("spans", lambda s: s["times"] >= F.col("pass"))
    part = F.array_join(F.flatten(F.transform(of_pass, lambda s: F.slice("words", (s["first"] + 1).cast("int"), s["words"].cast("int")))), "")
    cut = mixed.where("taken > 0").select("row", "spans", words.alias("words"), F.explode(passes).alias("pass")).select("row", part.alias("part"))
    own = {"text": F.col("part"), "n_chars": F.length("part").cast("long")}
    return cut.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
