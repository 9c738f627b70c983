"""Periodic runs against brute force, in any cut of the words into appends; edge cases; the query's rows."""

import hashlib
import random
import re
import time
import zlib

import numpy as np

from rowmill.llm.squares import SquareCatcher, collapsed, runs_of, word_runs
from rowmill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, shortest=12):
    """(start, length, period) of all runs, by start, then period."""
    smallest = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, 2 * q):
                smallest.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in smallest.items()), key=lambda r: (r[0], r[2]))


def sequences(draw):
    for _ in range(250):
        kind, n, k = draw.randrange(4), draw.randrange(120), draw.choice([1, 2, 2, 3, 5])
        if kind == 0:
            yield [draw.randrange(k) for _ in range(n)]
        elif kind == 1:  # a repeated part between others
            part = [draw.randrange(k) for _ in range(draw.randrange(1, 20))] * draw.randrange(1, 8)
            yield [draw.randrange(9) for _ in range(draw.randrange(20))] + part + [draw.randrange(2) for _ in range(20)]
        elif kind == 2:  # Fibonacci word: runs within runs
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield b[:n]
        else:  # Thue-Morse word: squares, none of which goes on
            yield [bin(i).count("1") % 2 for i in range(n)]


def test_runs_equal_brute_force():
    draw = random.Random(1)
    for words in sequences(draw):
        values, step = np.array(words, np.int64) * 7919 + 13, draw.choice([1, 7, 30, 1000])
        catcher = SquareCatcher()
        for at in range(0, len(values), step):
            catcher.append(values[at : at + step])
            if draw.random() < 0.1:  # results so far are those of the words so far
                assert list(map(tuple, catcher.runs().tolist())) == brute(words[: at + step])
        assert list(map(tuple, catcher.runs().tolist())) == brute(words)


def test_texts_read_one_after_the_other_do_not_mix():
    draw = random.Random(2)
    texts = [[b"%d" % w for w in words] for words in sequences(draw)] + [[], [b"a"] * 30, [b"a"] * 30, []]
    for text, runs in zip(texts, runs_of(texts)):
        assert list(map(tuple, runs.tolist())) == brute(text)


def test_longer_shortest_run():
    words = [b"a", b"b"] * 8 + [b"x"] + [b"c"] * 20
    assert [r.tolist() for r in runs_of([words], shortest=18)] == [[[17, 20, 1]]]


def test_one_word_throughout_is_quick():
    began = time.time()
    catcher = SquareCatcher()
    catcher.append(np.ones(200_000, np.int64))
    assert catcher.runs().tolist() == [[0, 200_000, 1]]
    assert time.time() - began < 20


def test_collapsed_keeps_the_first_period():
    words = b"x a b c a b c a b c a b c y".split()
    assert collapsed(words, runs_of([words])[0]) == b"x a b c y".split()


def test_edge_cases(spark):
    rows = [(1, None), (1, ""), (None, " \t\n"), (2, "a " * 12), (2, "a " * 12), (3, "A a " * 6), (4, "one"), (-5, "é é " * 12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as `runs`", "2 as `a.b`")
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in word_runs(docs).collect()]
    assert got == [
        (1, [], ""), (1, [], ""), (None, [], ""), (2, [(0, 12, 1)], "a"), (2, [(0, 12, 1)], "a"),
        (3, [(0, 12, 2)], "A a"), (4, [], "one"), (-5, [(0, 12, 1)], "é é"),
    ]
    assert word_runs(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " \n".join(draw.choice(vocabulary) for _ in range(draw.randrange(0, 90)))) for i in range(150)] + [(None, "b " * 40), (151, None), (152, "c 　" * 50)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    periodic = 0
    for doc_id, text in rows:
        words, n = WORD.findall(text or ""), len(WORD.findall(text or ""))
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            periodic += 1
        runs = brute(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        row = got[doc_id]
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        kept = words if h % 10 == 0 else WORD.findall(text or "")
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(kept) if i not in dropped).encode()).hexdigest()
    assert periodic > 5
