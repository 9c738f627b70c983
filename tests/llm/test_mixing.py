"""Targets against the iterative definition, quotas against a list of all quotients, totals near targets."""

import re

import pytest

from rowmill.llm.mixing import apportion, mix, mixed_documents, source_targets

WEIGHTS = (5, 2, 1)
SCHEMA = "doc_id long, text string, source string, n_chars long, size string"


def water(sizes):
    """Deal by weight, cut at twice the size, deal what was cut again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, rest = {s: 0.0 for s in order}, 1.5 * sum(sizes.values())
    open_ = set(order)
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += rest * weight[s] / total
        rest = sum(max(0, target[s] - 2 * sizes[s]) for s in order)
        for s in order:
            if target[s] >= 2 * sizes[s]:
                target[s] = 2 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, None: 500, "z": 3}, {"a": 7}, {"a": 0, "b": 5},
    {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}, {"big": 5000, "x": 1, "y": 1},
])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(water(sizes))


def test_quotas_are_highest_quotients(spark):
    claims = {k: (k * 7919) % 101 for k in range(9)}
    for seats in (0, 1, 4, 17, 200):
        frame = spark.createDataFrame([(1, k, float(c), seats) for k, c in claims.items()], "g int, k int, claim double, seats long")
        got = {r.k: r.quota for r in apportion(frame, ["g"], ["k"], "claim", "seats").collect()}
        quotients = sorted(((-c / (2 * i + 1), k) for k, c in claims.items() if c for i in range(seats + 1)))[:seats]
        assert got == {k: sum(q[1] == k for q in quotients) for k in claims}


def texts():
    rows = [(i, " ".join(f"w{i}_{j}" for j in range((i * 13) % 70)), f"s{i % 4}", 5, "x") for i in range(300)]
    return rows + [(None, "a b\tc", None, 5, "x"), (301, None, "s1", None, "x"), (302, "", "s2", 0, "x"), (303, " \n ", None, 3, "x"), (7, rows[7][1], "s3", 5, "x"), (7, rows[7][1], "s3", 5, "x")]


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.createDataFrame(texts(), SCHEMA)
    options = {"block_words": 16, "shard_words": 400}
    got = mix(docs, **options).collect()
    again = mix(docs.repartition(7), **options).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.source or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == 306
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert target == pytest.approx(water(sizes))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * 16 + 0.02 * target[s]
    assert sizes["s1"] == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, s, _, _ in texts() if s == "s1")


def test_mixed_documents_hold_the_taken_words(spark):
    docs = spark.createDataFrame(texts(), SCHEMA)
    options = {"block_words": 16, "shard_words": 400}
    words = {}
    for r in mixed_documents(docs, **options).collect():
        assert r.asDict().keys() == set(docs.columns) and r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    want = {}
    for r in mix(docs, **options).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert words == {k: n for k, n in want.items() if n}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).count() == 0 and mixed_documents(docs).count() == 0


def test_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x", 0.5)], "doc_id long, text string, source string, `meta.score` double")
    assert mixed_documents(docs).columns == docs.columns


def test_null_and_repeated_ids_are_dealt_to_all_shards(spark):
    rows = [(i if i % 3 else None, f"word{i} a b c d e f g", "hot", 1, "x") for i in range(900)]
    got = mix(spark.createDataFrame(rows, SCHEMA), block_words=16, shard_words=800).collect()
    shards = [r.shard for r in got if r.doc_id is None]
    assert len(set(shards)) > 5 and max(shards.count(s) for s in set(shards)) < 100 and len(got) == 900
    assert abs(sum(r.taken for r in got) - got[0].target) <= 2 * 16 + 0.02 * got[0].target
