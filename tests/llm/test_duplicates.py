"""Near duplicates and repeated bytes against brute force; fingerprints; the filter that keeps one of a group."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowmill.llm import near_duplicates as nd
from rowmill.llm.fingerprints import containment, fingerprints, likeness, merged, with_sketch
from rowmill.llm.near_duplicates import near_duplicates, without_near_duplicates
from rowmill.llm.repeats import LENGTH, repeated_bytes
from rowmill.llm.shingles import shingle_sets, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORD.findall(ascii_lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """Smallest reachable id of every document, from all pairs."""
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1 :]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets}


def corpus(seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    make = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    rows, passage = [], make(30)
    for _ in range(25):
        base = make(draw.randrange(1, 120))
        rows.append(base)
        for _ in range(draw.randrange(0, 6)):
            copy = list(base)
            for _ in range(draw.randrange(0, 6)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append(copy)
    family = make(150)  # a large group whose members are linked with some others only
    for _ in range(60):
        rows.append([w if draw.random() > 0.025 else draw.choice(vocabulary) for w in family])
    rows += [passage + make(40) for _ in range(20)] + [make(3)] * 3 + [["the"] * 500]
    texts = [" ".join(r) for r in rows] + ["", " \n", None, "One TWO three four", "one two\tthree  four", rows[0][0].upper()]
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_greatest_id_is_not_null(spark):
    same, other = "a b c d e f g h", "x y z x y z w"
    rows = [((1 << 63) - 1, other), ((1 << 63) - 1, "one two"), (None, same), ((1 << 63) - 1, same.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got) == [*[(str((1 << 63) - 1), (1 << 63) - 1, True)] * 3, ("None", (1 << 63) - 1, False)]
    kept = without_near_duplicates(docs).collect()
    assert sorted(r.text for r in kept) == sorted([other, "one two", same.upper()])


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, node string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == components(rows)


def test_open_lists_are_compared_completely(spark, monkeypatch):
    monkeypatch.setattr(nd, "STAR_ROUNDS", 0)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()} == components(rows)


def test_one_of_each_group_stays(spark):
    long = " ".join(f"a{i}" for i in range(50))
    other = " ".join(f"b{i}" for i in range(50))
    rows = [(9, long, 1), (4, long + " x", 2), (7, other, 3), (7, other, 4), (5, None, 5), (6, "", 6), (None, other + " y", 7), (None, "alone here", 8), (4, "same id, other words", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    left = sorted((r.kept for r in without_near_duplicates(docs).collect()))
    assert left in ([2, 3, 5, 6, 8, 9], [2, 4, 5, 6, 8, 9])
    assert without_near_duplicates(docs).columns == docs.columns
    assert near_duplicates(docs.limit(0)).count() == 0 and without_near_duplicates(docs.limit(0)).count() == 0


def test_word_hashes():
    texts = pa.array(["A bc\td", None, "", "a BC d", "é a", "a", " a bc d\n"])
    h, at = words(texts)
    per_row = [h[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert per_row[0] == per_row[3] == per_row[6] and len(per_row[0]) == 3 and per_row[1] == per_row[2] == []
    assert per_row[4][1] == per_row[5][0] == per_row[0][0]
    assert [len(s) for s in shingle_sets(texts)] == [1, 0, 0, 1, 1, 1, 1]
    many = pa.array([t for _, t in corpus(4)])
    assert [len(s) for s in shingle_sets(many)] == [len(shingles(t)) for t in many.to_pylist()]


def test_words_of_long_texts_are_hashed_in_parts(monkeypatch):
    draw = random.Random(2)
    texts = pa.array([" ".join("".join(draw.choice("abÉ") for _ in range(draw.randrange(1, 9))) for _ in range(n)) for n in (3_000, 0, 1, 40)] + ["x" * 900, None, " y "])
    whole = words(texts)
    monkeypatch.setattr("rowmill.llm.shingles.HASHED_BYTES", 64)
    monkeypatch.setattr("rowmill.llm.shingles.SLICE_BYTES", 128)
    monkeypatch.setattr("rowmill.llm.shingles._powers", {})
    parts = words(texts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and len(whole[0]) == 3_043
    assert len(set(whole[0].tolist())) == len({w for t in texts.to_pylist() for w in (t or "").split()})


def repeats(rows):
    first = {}
    for d, t in rows:
        for p in range(len(t) - LENGTH + 1):
            g = t[p : p + LENGTH]
            first[g] = min(first.get(g, d), d)
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - LENGTH + 1):
            if first[t[p : p + LENGTH]] < d:
                gone[p : p + LENGTH] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_repeated_bytes_equal_brute_force(spark):
    draw = random.Random(3)
    text = lambda n: "".join(draw.choice("ab é") for _ in range(n))
    common, rows = text(70), []
    for i in range(120):
        kind = draw.random()
        t = text(draw.randrange(0, 260))
        if kind < 0.4:  # a passage in changing surroundings
            t = text(draw.randrange(0, 60)) + common[: draw.randrange(40, 70)] + text(draw.randrange(0, 60))
        elif kind < 0.6 and rows:
            t = draw.choice(rows)[1] or ""
            cut = draw.randrange(len(t) + 1)
            t = t[:cut] + draw.choice(["", "x", text(5)]) + t[cut:]
        rows.append((draw.randrange(150), t))
    rows += [(200, "a" * 500), (201, "b" + "a" * 300), (202, None), (203, ""), (3, "q" * 60), (3, "q" * 60), (1, "q" * 61), (3, "z" * 70), (2, "z" * 49)]
    unique = collections.Counter(d for d, _ in rows)
    assert max(unique.values()) > 1
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, rank string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_bytes(docs).collect())
    assert got == sorted(repeats([(d, (t or "").encode()) for d, t in rows]))
    assert repeated_bytes(docs.limit(0)).count() == 0


def test_hot_passages_over_many_slices(spark):
    """Passages of a third of all texts, in equal and in changing surroundings, dealt to many slices; null ids among them."""
    draw = random.Random(11)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    hot, alike = text(80), text(120)
    rows = []
    for i in range(400):
        kind = i % 6
        body = text(20) + hot + text(20) if kind in (0, 1) else text(9) + hot[:55] if kind == 2 else alike if kind == 3 else text(90) + alike[:70] if kind == 4 else text(150)
        rows.append((None if draw.random() < 0.3 else draw.randrange(1000), body))
    draw.shuffle(rows)
    last = 1 << 62
    want = sorted((-1 if d == last else d, *rest) for d, *rest in repeats([(last if d is None else d, t.encode()) for d, t in rows]))
    for partitions in (1, 13):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
        got = repeated_bytes(docs).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_null_ids_come_last_for_repeats(spark):
    docs = spark.createDataFrame([(None, "q" * 60), (5, "q" * 55)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeated_bytes(docs).collect()}
    assert got == {None: 60, 5: 0}


def test_many_texts_under_one_null_id(spark):
    """More than 32,768 different texts under the null id, a quarter of which repeat the first document after their own number."""
    shared, n = "shared passage of sixty bytes, the same in every text, end.", 33_500
    docs = spark.range(n, numPartitions=4).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.concat(F.col("id").cast("string"), F.expr("repeat('.', id % 3)"), F.when(F.col("id") % 4 == 0, shared).otherwise("")).alias("text"),
    )
    docs = docs.unionByName(spark.createDataFrame([(5, shared)], "doc_id long, text string"))
    want = {}
    for i in range(n):
        own = f"{i}{'.' * (i % 3)}"
        want[hashlib.sha256(own.encode()).hexdigest()] = len(shared) if i % 4 == 0 else 0
    got = repeated_bytes(docs).where("doc_id is null").collect()
    assert len(got) == n and {r.kept_sha256: r.n_removed for r in got} == want


def test_fingerprints(spark):
    rows = corpus(5) + [(7, "again again again again again again", ), (7, "again again again again again again"), (None, "no id at all here now"), (1000, "é" * 7)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, sketch string")
    got = fingerprints(docs).collect()
    assert len(got) == len(rows)
    distinct = {(d, t or "") for d, t in rows}
    order = sorted((d for d in distinct if list(x[0] for x in distinct).count(d[0]) == 1 and d[0] is not None), reverse=True)
    shown = {(r.doc_id, r.edited_text): r for r in got}
    following = {a[0]: b for a, b in zip(order, order[1:]) if b[0] == a[0] - 1}
    checked = 0
    for d, t in order:
        if d in following and d - 1 != 7 and d != 7:
            n = len(t) // 2
            edited = t[: len(t) - n] + following[d][1][:n]
            r = shown[d, edited]
            a, b, c = shingles(t), shingles(edited), shingles(following[d][1])
            if max(map(len, (a, b, c))) <= 48:
                assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
                assert r.near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1)
            else:
                assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 0.35
            checked += 1
    assert checked > 50
    assert fingerprints(docs.limit(0)).count() == 0
    alone = fingerprints(docs.where("doc_id = 1000")).collect()
    assert [(r.edited_text, r.near_edited, r.near_next) for r in alone] == [("é" * 7, 1.0, 1.0)]


def test_sketches_merge_and_contain(spark):
    many = " ".join(f"w{i}" for i in range(6000))
    part = " ".join(f"w{i}" for i in range(1000, 1600))
    frame = spark.createDataFrame([(many, part, many + " | " + part)], "a string, b string, both string")
    for name in ("a", "b", "both"):
        frame = with_sketch(frame, name, f"s{name}")
    union, limit = merged("sa", "sb")
    frame = frame.withColumn("su", union).withColumn("su_limit", limit)
    r = frame.select(containment("sb", "sa").alias("in"), containment("sa", "sb").alias("out"), likeness("sa", "sboth").alias("near"), F.size(F.array_except("su", "sboth")).alias("missing")).first()
    assert r["in"] == 1.0 and abs(r["out"] - 0.1) < 0.04 and r["near"] > 0.97 and r["missing"] == 0
