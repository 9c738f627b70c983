"""Near-duplicate documents by an inverted join on MinHash signature coordinates.

Each class of equal word sequences is one node with a signature of ``COORDINATES`` minima over its word shingles.
Nodes are posted under their (coordinate, value) tokens. Two nodes are candidates if at least ``MATCHES`` tokens
collide; such a pair must meet in a prefix of ``COORDINATES - MATCHES + 1`` tokens of either node, so only the
rarest tokens of a node are posted and its most common ones are skipped. Candidates are confirmed on the full
shingle sets. A pair with similarity 0.75 has fewer than MATCHES collisions with a probability below 1e-7.

Only connectivity is asked for, so a posting list is never expanded into all its pairs while links are found:
in each round the members are compared with one centre per list, linked nodes share a label from then on, and a list
under one label is done. Rounds end when they find next to nothing. What is left after these rounds is compared completely across labels, each pair once.
Before sets are compared, a bitmap of each set (bit h mod 1024 flips with every shingle hash h) rules out pairs: the
bits in which two bitmaps differ are at most the shingles in which the sets differ, so nothing similar is lost.

Edge cases: null, empty and blank texts have no shingles and no links; fewer words than a shingle make one shingle of
the whole sequence; a null id is taken as larger than all others; repeated ids are separate documents; an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.components import merge_labels
from rowmill.llm.shingles import random_words, shingle_sets, shingles, slices, words
from rowmill.llm.tables import WORD
from rowmill.llm.workers import returning_memory
from rowmill.storage import materialize

COORDINATES = 40
MATCHES = 14
STAR_ROUNDS = 4
IDLE_SHARE = 100  # a round with fewer than one link in so many pairs is the last
BITS = 1024
_MULTIPLY = random_words(COORDINATES, 3) | np.uint64(1)
_FLIP = random_words(COORDINATES, 4)
SIGNED = "doc_id long, digest string, n_shingles long, node binary, signature array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, digests, texts = batch.columns
        for begin, end in slices(texts):
            part = texts.slice(begin, end - begin)
            nodes = _nodes(*words(part))
            s, at = shingles(part)
            n, full = len(at) - 1, np.flatnonzero(np.diff(at))
            minima = np.zeros((COORDINATES, len(full)), np.uint64)
            if len(full):
                for c in range(COORDINATES):
                    minima[c] = np.minimum.reduceat((s ^ _FLIP[c]) * _MULTIPLY[c], at[:-1][full])
            counts = [len(np.unique(s[a:b])) for a, b in zip(at[:-1], at[1:])]
            sizes = np.zeros(n + 1, np.int32)
            sizes[1:][full] = COORDINATES
            signatures = pa.ListArray.from_arrays(np.cumsum(sizes, dtype=np.int32), pa.array(minima.T.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(begin, end - begin), digests.slice(begin, end - begin), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), signatures],
                ["doc_id", "digest", "n_shingles", "node", "signature"],
            )


def _nodes(h: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Name of each row's word sequence."""
    return [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:])]


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in slices(batch.column(0)):
            part = batch.column(0).slice(begin, end - begin)
            sets = shingle_sets(part)
            bits = [np.packbits(np.bincount((x & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).view(np.int64) for x in sets]
            columns = [
                pa.array(_nodes(*words(part)), pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                pa.array([len(x) for x in sets], pa.int64()), pa.array(bits, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles", "n", "bits"])


def _collisions(one: str, other: str):
    return F.aggregate(F.zip_with(one, other, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def _may_be_similar(one: str, other: str, per_cent: int):
    """False only if the sets are surely too different, by size or by bitmap. Both arguments name structs."""
    n, m = F.col(f"{one}.n"), F.col(f"{other}.n")
    apart = F.bit_count(F.get(f"{one}.bits", F.lit(0)).bitwiseXOR(F.get(f"{other}.bits", F.lit(0))))
    for i in range(1, BITS // 64):
        apart = apart + F.bit_count(F.get(f"{one}.bits", F.lit(i)).bitwiseXOR(F.get(f"{other}.bits", F.lit(i))))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * per_cent) & (apart * (100 + per_cent) <= (n + m) * (100 - per_cent))


def _ordered(doc_id: str):
    """An id that can be compared, null after all others."""
    return F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id"))


def near_duplicates(docs: DataFrame, per_cent: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, digest, node, component_id, component, kept``.

    ``component_id`` is the smallest id reachable over links; ``kept`` marks the document with that id. ``node`` is
    equal for documents with equal words, ``component`` is the node that names the component, ``digest`` the text's MD5.
    """
    signed = materialize(docs.select("doc_id", F.md5("text").alias("digest"), "text").mapInArrow(returning_memory(_signed), SIGNED), "signatures")
    at_least_one = signed.where("n_shingles > 0")
    classes = materialize(
        at_least_one.groupBy("node").agg(F.min(_ordered("doc_id")).alias("least"), F.first("signature").alias("signature")), "classes"
    )
    token = F.posexplode("signature").alias("coordinate", "value")
    tokens = classes.select("node", token).select("node", F.xxhash64("coordinate", "value").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("frequency")).where("frequency > 1")
    prefix = F.slice(F.array_sort(F.collect_list(F.struct("frequency", "token"))), 1, F.greatest(F.count("*") - (MATCHES - 1), F.lit(0)).cast("int"))
    # A token of one node comes before all shared ones in its order: the prefix ends as many places earlier.
    posted = materialize(
        tokens.join(shared, "token").groupBy("node").agg(prefix.alias("prefix"), F.sum(F.log2("frequency")).alias("degree")).where(F.size("prefix") > 0), "posted"
    )
    postings = materialize(posted.select("node", "degree", F.explode("prefix.token").alias("token")), "postings")
    nodes = materialize(
        posted.select("node").join(classes, "node").select("node", "signature", F.struct("least", "node").alias("label")), "nodes"
    )
    sets = _sets(docs, nodes)
    labels = nodes.select("node", "label")
    tested = None
    for turn in range(STAR_ROUNDS):
        current = postings.join(labels, "node")
        score = F.col("degree") if turn == 0 else F.xxhash64(F.lit(turn), F.col("node"))
        lists = current.groupBy("token").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.max_by(F.struct("node", "label"), F.struct(score, "node")).alias("centre")
        ).where("low <> high")
        pairs = (
            current.join(lists, "token")
            .where("label <> centre.label")
            .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
            .distinct()
        )
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "star-pairs")
        if pairs.isEmpty():
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = _links(pairs, nodes, sets, per_cent)
        labels = merge_labels(labels, links)
        if links.count() * IDLE_SHARE < pairs.count():
            break  # centres link next to nothing any more
    labels = merge_labels(labels, _links(_open_pairs(posted, postings, labels, sets, tested, per_cent), nodes, sets, per_cent))
    found = labels.select("node", F.col("label.least").alias("found"), F.col("label.node").alias("component"))
    known = signed.drop("signature").join(classes.select("node", "least"), "node", "left").join(found, "node", "left")
    smallest = F.when(F.col("n_shingles") > 0, F.coalesce("found", "least")["id"]).otherwise(F.col("doc_id"))
    result = known.select("doc_id", "n_shingles", "digest", "node", smallest.alias("component_id"), F.coalesce("component", "node").alias("component"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full shingle sets of the nodes that have postings, from the text of their smallest id."""
    wanted = nodes.select(F.col("label.least.id").alias("id")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).dropDuplicates(["doc_id", "text"])
    return materialize(texts.select("text").mapInArrow(returning_memory(_with_sets), "node binary, shingles array<long>, n long, bits array<long>"), "shingle-sets")


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The candidates with enough collisions whose full sets are similar."""
    facts = nodes.select("node", "signature").join(sets.select("node", F.struct("n", "bits").alias("seen")), "node")
    side = lambda name: facts.select(F.col("node").alias(name), F.col("signature").alias(f"s{name}"), F.col("seen").alias(f"f{name}"))
    near = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(_may_be_similar("fa", "fb", per_cent) & (_collisions("sa", "sb") >= MATCHES))
        .select("a", "b")
    )
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    # Row by row in the JVM: a batch of pairs of long sets would be held whole by a Python worker.
    both = near.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("left", "right")))
    similar = F.col("common") * 100 >= (F.size("left") + F.size("right") - F.col("common")) * per_cent
    return materialize(both.where(similar).select("a", "b"), "links")


def _open_pairs(posted: DataFrame, postings: DataFrame, labels: DataFrame, sets: DataFrame, tested: DataFrame | None, per_cent: int) -> DataFrame:
    """All pairs across labels in the lists that still have more than one label, each at its first common token."""
    current = postings.select("node", "token").join(labels, "node")
    open_lists = current.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    facts = posted.select("node", F.array_sort("prefix.token").alias("tokens")).join(sets.select("node", F.struct("n", "bits").alias("seen")), "node")
    rest = current.join(open_lists, "token").join(facts, "node").select("token", "node", F.col("label.node").alias("label"), "tokens", "seen")
    one, other = rest.alias("x"), rest.alias("y")
    across = (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
    once = F.array_min(F.array_intersect("x.tokens", "y.tokens")) == F.col("x.token")
    cross = one.join(other, across & _may_be_similar("x.seen", "y.seen", per_cent) & once)
    pairs = cross.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "open-pairs")


def without_near_duplicates(docs: DataFrame, per_cent: int = 75) -> DataFrame:
    """One document of each component with all its columns: that with the smallest id, of repeated rows one.

    Documents without words are linked with nothing and all stay.
    """
    decided = near_duplicates(docs, per_cent).where(F.col("kept") & (F.col("n_shingles") > 0) & (F.col("node") == F.col("component")))
    chosen = decided.groupBy("doc_id", "node", "digest").agg(F.count("*").alias("rows")).groupBy("doc_id", "node").agg(F.min(F.struct("digest", "rows")).alias("first"))
    chosen = materialize(chosen.select(F.col("doc_id").alias("chosen_id"), F.col("first.digest").alias("chosen"), "first.rows"), "chosen")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    blank = F.coalesce(~F.col("text").rlike(WORD), F.lit(True)).alias("blank")
    rows = docs.select("doc_id", F.md5("text").alias("digest"), blank, row)
    own = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("digest") == F.col("chosen"))
    kept = rows.join(chosen, own, "left").where(F.col("blank") | F.col("chosen").isNotNull())
    if not chosen.where("rows > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.lit(1)))
        kept = kept.withColumn("nth", F.when(F.col("rows") > 1, nth).otherwise(1)).where("nth = 1")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
