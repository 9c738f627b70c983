"""Interpolated scores against a plain model of the same definition; long texts in parts; edge cases."""

import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rowmill.llm import interpolation as lm
from rowmill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + [("end",)]


def counted(texts):
    grams = collections.Counter()
    for text in texts:
        t = [("begin",), ("begin",), *tokens(text)]
        for i in range(2, len(t)):
            grams.update([(t[i],), tuple(t[i - 1 : i + 1]), tuple(t[i - 2 : i + 1])])
            grams.update([("before", t[i - 1]), ("before", t[i - 2], t[i - 1])])
    return grams


class Plain:
    def __init__(self, texts):
        self.grams = counted(texts)
        self.n = sum(len(tokens(t)) for t in texts)
        self.known = sum(len(g) == 1 for g in self.grams)

    def parts(self, u, v, w):
        two, one = self.grams["before", u, v], self.grams["before", v]
        bucket = two.bit_length() - 1 if two else 64 + one.bit_length() - 1 if one else lm.BUCKETS - 1
        ratio = lambda a, b: a / b if b else 0.0
        return bucket, [ratio(self.grams[u, v, w], two), ratio(self.grams[v, w], one), ratio(self.grams[(w,)], self.n), 1 / (self.known + 1)]

    def log(self, text, weights):
        t = [("begin",), ("begin",), *tokens(text)]
        total = 0.0
        for i in range(2, len(t)):
            bucket, parts = self.parts(*t[i - 2 : i + 1])
            total += math.log10(sum(a * b for a, b in zip(weights[bucket], parts)))
        return total

    def base(self, text):
        return sum(math.log10((self.grams[(w,)] + 0.1) / (self.n + 0.1 * (self.known + 1))) for w in tokens(text))


def plain_scores(rows):
    """Rows of (text, fold); the score of each."""
    kept, deleted = Plain([t for t, f in rows if f == lm.KEPT]), [t for t, f in rows if f == lm.DELETED]
    events = [kept.parts(*t[i - 2 : i + 1]) for t in ([("begin",), ("begin",), *tokens(x)] for x in deleted) for i in range(2, len(t))]
    weights, best = [[0.25] * 4 for _ in range(lm.BUCKETS)], -math.inf
    for _ in range(lm.MOST_STEPS):
        sums, score = collections.defaultdict(lambda: [0.25] * 4), 0.0
        for bucket, parts in events:
            p = [a * b for a, b in zip(weights[bucket], parts)]
            sums[bucket] = [s + x / sum(p) for s, x in zip(sums[bucket], p)]
            score += math.log10(sum(p))
        if not events or score / len(events) - best < lm.LEAST_GAIN:
            break
        best = score / len(events)
        for bucket, s in sums.items():
            weights[bucket] = [x / sum(s) for x in s]
    model = Plain([t for t, f in rows if f != lm.UNSEEN])
    return [(model.log(t, weights), model.base(t), len(tokens(t)), sum(model.grams[(w,)] > 0 for w in tokens(t)), model.n) for t, _ in rows], model, weights


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "É"]
    rows = [(i, draw.choice([" ", "\n ", "\t"]).join(vocabulary[int(draw.random() ** 3 * 63)] for _ in range(draw.randrange(0, 60)))) for i in range(300)]
    return rows + [(None, None), (None, "the end"), (5, ""), (5, "w1 w2"), (5, "w1 w2"), (-3, "w1 w2"), (7, "w5 " * 700)]


def test_scores_equal_a_plain_model(spark):
    docs = spark.createDataFrame(corpus(1), "doc_id bigint, text string").withColumn("text", F.col("text")).withColumn("score", F.lit(1)).withColumn("a.b", F.lit(2))
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(True))
    deleted = F.pmod(F.xxhash64("doc_id", "text"), F.lit(10)) == 0
    folds = docs.select("doc_id", "text", F.when(~learn, lm.UNSEEN).when(deleted, lm.DELETED).otherwise(lm.KEPT).alias("fold")).collect()
    want, _, _ = plain_scores([(r.text, r.fold) for r in folds])
    assert len({r.fold for r in folds}) == 3
    for slice_bytes in (lm.SLICE_BYTES, 500):  # 500 bytes: many slices and ranges, the longest text in parts
        got = lm.interpolated_scores(docs, learn, slice_bytes).collect()
        key = lambda r: (str(r[0]), r[1], r[2], round(r[5], 6))
        rows = sorted((tuple(r) for r in got), key=key)
        expected = sorted(((f.doc_id, n, known, total, base, score) for f, (score, base, n, known, total) in zip(folds, want)), key=key)
        assert len(rows) == len(expected)
        for a, b in zip(rows, expected):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_probabilities_sum_to_one():
    rows = [(t, lm.DELETED if i % 9 == 0 else lm.KEPT) for i, (_, t) in enumerate(corpus(2))]
    _, model, weights = plain_scores(rows)
    words = [g[0] for g in model.grams if len(g) == 1] + ["unknown"]
    for context in (("begin",), ("begin",)), (("begin",), "w1"), ("w1", "w2"), ("never", "w1"), ("never", "seen"):
        total = 0.0
        for w in words:
            bucket, parts = model.parts(*context, w)
            total += sum(a * b for a, b in zip(weights[bucket], parts))
        # a context that was not seen leaves the weight of its estimates unused
        assert total == pytest.approx(1.0) or ("never" in context and total < 1.0)


def test_no_training_texts_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in lm.interpolated_scores(docs, F.lit(False)).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].train_tokens, rows[1].base_score) == (3, 0, 0, 0.0)
    assert rows[1].score < 0 and rows[2].n_tokens == 1
    assert lm.interpolated_scores(docs.limit(0), F.lit(True)).count() == 0


def test_query_scores_held_out_texts_better_than_its_base(spark, tmp_path):
    draw = random.Random(4)
    phrases = [" ".join(draw.choice("abcdefghij") * draw.randrange(1, 4) for _ in range(6)) for _ in range(40)]
    rows = [(i, " ".join(draw.choice(phrases) for _ in range(draw.randrange(1, 30)))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_interpolated_scores"](spark, str(tmp_path)).collect()
    held_out = [r for r in got if r.held_out]
    assert {r.doc_id for r in held_out} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    assert sum(r.score for r in held_out) > 0.6 * sum(r.base_score for r in held_out)
    assert sorted((r.doc_id, r.score) for r in got) == sorted((r.doc_id, r.score) for r in QUERIES["op13_interpolated_scores"](spark, str(tmp_path)).collect())
