"""Prefix trie of conversations, as balanced parentheses per shard.

A conversation is a sequence of turns. Every turn is written as a record of fixed size (digest of role and text, bytes of the text), so
a conversation is a string of records, and sorting these strings puts the trie in preorder. Spark cuts the sorted distinct
sequences into shards. A shard is one string of parentheses, "(" where a node opens, ")" where its subtree ends; excess is the
number of open ones. Blocks of 2, 4, 8, ... excess values keep their least and greatest value, and ``find_close`` climbs from an opening one over
blocks that cannot hold the value it seeks, then descends into the first one that does. Between the two parentheses lies the
subtree: the rank of "()" pairs counts its leaves, cumulative arrays over the nodes in preorder give members and savings.

A node that a neighbouring shard holds too lies on the spine from the root to the border between them: on the first path of
the right shard and the last path of the left one. Each shard is told the path beyond either border, so it knows which nodes it
shares, counts what the left neighbour has counted already only once, and leaves shared nodes to be merged: one aggregate by
(depth, digest of the path), to which every shard adds one row per shared node.

Edge cases: null role or text is empty. Rows without a conversation id belong to no conversation. Turns are ordered by number, null first,
then by role and text; repeated rows are turns of their own. A conversation without turns ends at the root. No conversations: no nodes. A
conversation is held by one task at a time, as 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.session import ship_package
from rowmill.storage import materialize

RECORD = 24  # bytes of a turn: 16 of the digest of role and text, 8 of the text's length
SHARD_BYTES = 8 << 20  # paths of a shard
MEMBERS_TOGETHER = 20_000  # ids that are written as one piece of a digest's input
SPREAD = 16  # copies of a merged node, so that children of a common one are dealt to as many tasks
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path``: the records of each conversation's turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text)
    record = F.concat(F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)), F.lpad(F.hex(size.cast("bigint")), 16, "0"))
    # the digest breaks ties of role and text only where these are equal, so it orders them as well as they do
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), F.md5(text).alias("text"), record.alias("record")).alias("t")
    )
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t["record"]), "")).alias("path"))


def sequences(members: DataFrame) -> DataFrame:
    """Distinct paths: ``path, n, conv_id`` (number of conversations, smallest id) and ``ends``, the SHA-256 of their ids in order.

    Ids of one path are sorted and written in pieces by many tasks; one task only feeds a path's pieces to its digest.
    """
    keyed = materialize(members.withColumn("key", F.unhex(F.md5("path"))), "members")
    distinct = keyed.groupBy("key").agg(F.first("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begins = [i for i, key in enumerate(keys) if not i or key != keys[i - 1]]
            cuts = [c for a, b in zip(begins, [*begins[1:], len(keys)]) for c in range(a, b, MEMBERS_TOGETHER)]
            rows = [{"key": keys[a], "first": ids[a], "ids": ",".join(map(str, ids[a:b]))} for a, b in zip(cuts, [*cuts[1:], len(keys)])]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(ids.encode())
            yield _pairs(done)
            done = []
        yield _pairs(done if digest is None else [*done, (key, digest.hexdigest())])

    written = keyed.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first bigint, ids string")
    ends = written.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends string")
    return distinct.join(ends, "key").drop("key")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.string())], ["key", "ends"])


class Parentheses:
    """Opening and closing parentheses of a shard, with the least and greatest excess of blocks of every power of two."""

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int32)
        self.levels = [(self.excess, self.excess)]
        while len(self.levels[-1][0]) > 1:
            least, most = (np.concatenate([x, x[-1:]]) if len(x) % 2 else x for x in self.levels[-1])
            self.levels.append((least.reshape(-1, 2).min(axis=1), most.reshape(-1, 2).max(axis=1)))
        self.at = np.flatnonzero(opens)  # of each node, in preorder
        self.leaves = np.concatenate([[0], np.cumsum(opens[:-1] & ~opens[1:])])  # "()" pairs that start before a place
        self.nodes = np.concatenate([[0], np.cumsum(opens)])  # that open before a place

    def find_close(self) -> np.ndarray:
        """Place of the parenthesis that closes each node: the first later one with an excess one lower."""
        wanted = self.excess[self.at] - 1
        block, height, climbing = self.at + 1, np.zeros(len(self.at), np.int64), np.arange(len(self.at))

        def holds(level, at):
            least, most = self.levels[level]
            return (least[block[at]] <= wanted[at]) & (most[block[at]] >= wanted[at])

        top = len(self.levels) - 1
        for level in range(top + 1):
            # the first block of a pair is looked at together with the second, one level up
            alone = (block[climbing] % 2 == 1) | (level == top)
            ready = alone.copy()
            ready[alone] = holds(level, climbing[alone])
            height[climbing[ready]] = level
            block[climbing[alone & ~ready]] += 1
            climbing = climbing[~ready]
            block[climbing] //= 2
        for level in range(top, 0, -1):
            down = np.flatnonzero(height == level)
            block[down] *= 2
            height[down] = level - 1
            block[down[~holds(level - 1, down)]] += 1
        return block


def _least_between(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest of the values in each range that is not empty, by ranges of every power of two."""
    result = np.empty(len(begin), values.dtype)
    power = np.frexp(end - begin)[1] - 1
    for k in range(int(power.max()) + 1 if len(power) else 0):
        at = np.flatnonzero(power == k)
        result[at] = np.minimum(values[begin[at]], values[end[at] - (1 << k)])
        values = np.minimum(values[: -(1 << k)], values[1 << k :]) if len(values) > 1 << k else values
    return result


def _common(a: bytes, b: bytes) -> int:
    """Number of records that both paths begin with."""
    n = min(len(a), len(b)) // RECORD
    if a[: n * RECORD] == b[: n * RECORD]:
        return n
    x, y = (np.frombuffer(p, np.uint8, n * RECORD) for p in (a, b))
    return int(np.argmax(x != y)) // RECORD


_NODE = (
    "depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, once bigint, ends string, "
    "key binary, parent binary, parent_conv_id bigint"
)


def shard_nodes(rows: list[dict], before: bytes | None, after: bytes | None) -> dict[str, list]:
    """The nodes of one shard: its distinct paths in order, and the path before and after it.

    ``key`` is the digest of a shared node's path, ``parent`` that of a shared parent's. ``saved`` of a subtree is the sum of members
    times bytes, ``once`` that of bytes, where a node shared with the shard before counts no bytes and is no child.
    """
    sequences = [r["path"] for r in rows]
    lengths = np.array([len(p) // RECORD for p in sequences])
    common = np.array([0, *[_common(a, b) + 1 for a, b in zip(sequences, sequences[1:])]])  # open nodes that stay, the root among them
    new = lengths + 1 - common
    row = np.repeat(np.arange(len(rows)), new)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(new) - new, new) + common[row]
    closing = np.concatenate([lengths[:-1] + 1 - common[1:], lengths[-1:] + 1])
    opens = np.repeat(np.tile([True, False], len(rows)), np.stack([new, closing], axis=1).ravel())
    tree = Parentheses(opens)
    close = tree.find_close()
    first, last = np.arange(len(row)), tree.nodes[close]  # nodes of the subtree, in preorder

    ends_at = np.cumsum(new) - 1  # node where each path ends
    counts, least, ends = np.zeros(len(row), np.int64), np.full(len(row), np.iinfo(np.int64).max), [None] * len(row)
    for node, r in zip(ends_at, rows):
        counts[node], least[node], ends[node] = r["n"], r["conv_id"], r["ends"]
    total = np.concatenate([[0], np.cumsum(counts)])
    members = total[last] - total[first]
    smallest = _least_between(least, first, last)
    data, at = np.frombuffer(b"".join(sequences), np.uint8), np.cumsum(lengths) - lengths
    sizes = np.zeros(len(row), np.int64)
    deep = depth > 0
    records = (at[row[deep]] + depth[deep] - 1) * RECORD + 16
    for k in range(8):
        sizes[deep] = sizes[deep] * 256 + data[records + k]

    shared_before, shared_after = (-1 if other is None else _common(other, own) for other, own in ((before, sequences[0]), (after, sequences[-1])))
    known = (row == 0) & (depth <= shared_before)  # counted by the shard before
    on_last_path = last == len(row)
    spine_after = on_last_path & (depth <= shared_after)
    shared = known | spine_after
    per_node = np.stack([members * sizes, np.where(known, 0, sizes)])
    sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(per_node, axis=1)], axis=1)
    saved, once = sums[:, last] - sums[:, first]
    leaves = tree.leaves[close] - tree.leaves[tree.at]
    if shared_after == lengths[-1]:  # the last path goes on in the next shard: its end is no leaf
        leaves[on_last_path] -= 1
    order = np.lexsort((first, depth))
    previous = np.searchsorted(depth[order] * (len(row) + 1) + first[order], (depth - 1) * (len(row) + 1) + first) - 1
    parent = np.where(deep, order[np.maximum(previous, 0)], -1)  # the last node before it that is one less deep
    children = np.bincount(parent[deep & ~known], minlength=len(row))

    keys: list[bytes | None] = [None] * len(row)
    for line, path in ((np.flatnonzero(known), sequences[0]), (np.flatnonzero(spine_after), sequences[-1])):
        digest = hashlib.md5()
        for i, x in enumerate(sorted(line.tolist(), key=lambda x: depth[x])):
            digest.update(path[max(0, i - 1) * RECORD : i * RECORD])
            keys[x] = digest.digest()
    return {
        "depth": depth, "conv_id": smallest, "n_convs": members, "n_children": children, "n_leaves": leaves, "saved": saved, "once": once, "ends": ends,
        "key": keys, "parent": [keys[p] if p >= 0 else None for p in parent], "parent_conv_id": [int(smallest[p]) if p >= 0 and not shared[p] else None for p in parent],
    }


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by shard, then path; rows with a side hold the path beyond that border of the shard."""

    def finished(rows):
        beside = {r["side"]: r["path"] for r in rows if r["side"] is not None}
        own = [r for r in rows if r["side"] is None]
        if own:
            found = shard_nodes(own, beside.get(0), beside.get(1))
            kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
            fields = [f.split() for f in _NODE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(found[name], kinds[kind]) for name, kind in fields], [name for name, _ in fields])

    rows: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and rows[0]["shard"] != r["shard"]:
                yield from finished(rows)
                rows = []
            rows.append(r)
    yield from finished(rows)


def prefix_trie(members: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per distinct prefix of the paths of ``members`` (``conv_id, path``), from the root on.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    ship_package(members.sparkSession)
    distinct = materialize(sequences(members), "sequences")
    size = distinct.agg(F.sum(F.length("path") + 64).alias("size")).first()["size"] or 0
    shards = max(1, -(-size // shard_bytes))
    sharded = distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()) if shards > 1 else distinct.withColumn("shard", F.lit(0))
    sharded = materialize(sharded, "shards")

    # one row per shard, so one task orders them
    borders = sharded.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    numbered = materialize(borders.withColumn("place", F.row_number().over(Window.orderBy("shard"))), "borders")
    beyond = [
        numbered.select((F.col("place") + step).alias("place"), F.col(column).alias("path"), F.lit(side).alias("side")).join(numbered.select("place", "shard"), "place").drop("place")
        for step, column, side in ((1, "high", 0), (-1, "low", 1))
    ]
    rows = sharded.withColumn("side", F.lit(None).cast("int")).unionByName(beyond[0], True).unionByName(beyond[1], True)
    dealt = rows.select("shard", "side", "path", "n", "conv_id", "ends").repartition(shards, "shard").sortWithinPartitions("shard", "path")
    nodes = materialize(dealt.mapInArrow(_nodes, _NODE), "nodes")

    own = nodes.where("key is null").select("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "once", "ends", "parent", "parent_conv_id")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "once")]
    merged = materialize(nodes.where("key is not null").groupBy("depth", "key").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"), F.max("parent").alias("parent")), "merged")
    together = own.unionByName(merged.drop("key").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    open_rows, closed = together.where("parent is not null"), together.where("parent is null")
    parents = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    found = open_rows.withColumn("part", F.pmod(F.hash("conv_id", "depth"), F.lit(SPREAD))).join(parents, ["parent", "part"]).withColumn("parent_conv_id", F.col("found"))
    return closed.drop("parent").unionByName(found.drop("parent", "part", "found")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("saved") - F.col("once")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_HASH)).alias("ends_sha256")
    )


def shared_beginnings(conversations: DataFrame, base: Column, turns: Column, most_turns: int) -> DataFrame:
    """Paths after the first ``turns`` turns of each conversation are replaced by those of conversation ``base`` (none if it is absent).

    Both are columns over ``conv_id``; ``turns`` is at most ``most_turns``.
    """
    heads = conversations.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"), F.expr(f"substring(path, 1, {most_turns * RECORD})").alias("head"))
    joined = conversations.withColumn("base", base).withColumn("h", (turns * RECORD).cast("int")).join(heads, "base", "left")
    head = F.coalesce(F.substring("head", F.lit(1), F.col("h")), F.lit(b""))
    return joined.select("conv_id", F.concat(head, F.substring("path", F.col("h") + 1, F.length("path"))).alias("path"))
