"""The conversation trie against brute force, in one and in many shards; parentheses; edge cases."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from rowmill.llm import trie
from rowmill.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """Rows of the trie from ``{conv_id: [(role, text), ...]}``."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = lambda p: [q for q in below if len(q) == len(p) + 1 and q[: len(p)] == p]
        ends = sorted(c for c in members if len(conversations[c]) == len(path))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[path[:-1]]) if path else None
        rows.append((min(members), len(path), parent, len(members), len(children(path)), sum(not children(p) for p in below), saved, digest))
    return sorted(rows, key=str)


def rebuilt(rows):
    own = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest())):
        own.setdefault(c, []).append((role or "", text or ""))
    result = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        result[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return result


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def conversations(seed, n=150):
    draw = random.Random(seed)
    words = ["a", "b", "é", "", "long text " * 5]
    rows = []
    for c in range(n):
        if c % 7:
            rows += [(c, t, draw.choice(["user", "assistant"]), draw.choice(words)) for t in range(draw.randrange(1, 7))]
    return rows


def test_find_close_on_random_trees():
    draw = random.Random(3)
    for _ in range(60):
        opens, stack, want, at = [True], [0], {}, 1
        size = draw.randrange(1, 200)
        while stack:
            if size and draw.random() < 0.5:
                stack.append(at)
                opens.append(True)
                size -= 1
            else:
                want[stack.pop()] = at
                opens.append(False)
            at += 1
        tree = trie.Parentheses(np.array(opens))
        assert tree.find_close().tolist() == [want[p] for p in tree.at]


def test_query_against_brute_force(spark, tmp_path):
    rows = conversations(1) + [(None, 1, "user", "x"), (300, None, None, None), (300, 5, "user", "a"), (300, 5, "user", "a"), (301, 2, None, "b"), (302, 0, "user", None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(1)).withColumn("a.b", F.lit(2)).write.parquet(f"{tmp_path}/conversations.parquet")
    assert collected(QUERIES["op11_conversation_trie"](spark, str(tmp_path))) == brute(rebuilt(rows))


def test_many_shards_equal_one(spark):
    rows = conversations(2)
    members = trie.paths(spark.createDataFrame(rows, SCHEMA))
    plain = {}
    for c, _, role, text in rows:
        plain.setdefault(c, []).append((role, text))
    for shard_bytes in (trie.SHARD_BYTES, 1_000, 100):
        assert collected(trie.prefix_trie(members, shard_bytes)) == brute(plain)


def test_common_beginnings_and_deep_paths_over_shards(spark):
    turns = [("user", f"t{i % 3}") for i in range(60)]
    plain = {c: turns[: 1 + c % 60] + [("user", str(c))] * (c % 2) for c in range(400)}  # every border cuts a long spine
    rows = [(c, t, *turn) for c, path in plain.items() for t, turn in enumerate(path)]
    members = trie.paths(spark.createDataFrame(rows, SCHEMA))
    assert collected(trie.prefix_trie(members, 3_000)) == brute(plain)


def test_one_path_with_many_members(spark):
    rows = [(c, 0, "user", "hi") for c in range(50_000)] + [(-4, 0, "user", "other")]
    got = collected(trie.prefix_trie(trie.paths(spark.createDataFrame(rows, SCHEMA))))
    ids = hashlib.sha256(",".join(map(str, range(50_000))).encode()).hexdigest()
    assert (0, 1, -4, 50_000, 0, 1, 2 * 49_999, ids) in got and len(got) == 3


def test_no_conversations(spark):
    assert trie.prefix_trie(trie.paths(spark.createDataFrame([], SCHEMA))).collect() == []
    assert trie.prefix_trie(trie.paths(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))).collect() == []
