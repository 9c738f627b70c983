"""Log probabilities of whole texts under a trigram model with deleted interpolation.

A word's probability after the two words before it is a mixture of four estimates: relative frequencies of trigram, bigram
and word, and one over the number of known words and one unknown. The mixture weights depend on a bucket, the power
of two of how often the context was seen: the two words before, else the one word before, else none. They are learned by
expectation-maximisation: a tenth of the training texts is deleted, the frequencies of the others are mixed to predict its
counts, and every step is one aggregate by bucket over all its counts. The model then takes frequencies from all training texts.

How it runs. Texts are read in slices of some megabytes, which are written as word numbers. A slice sends its distinct words, bigrams and trigrams, as hashes with counts, to
ranges of hashes (one shuffle); there the counts of all slices are added, and each slice is answered with the totals of what it sent, in its own order.
So an n-gram in a third of all texts is one row per slice, and nothing is broadcast but some hundred weights and four totals. The
number of ranges grows with the text. Words have 64-bit hashes. Longer n-grams have log2 of the text's bytes plus 14 bits, at most 64: an unseen one is taken for
a seen one with a probability of about 2^-14.

Edge cases: a null text is an empty one, whose only token is its end. Null and repeated ids are kept, a row each; null ids
are learned from as the caller's column says. Without training texts every estimate but the last is zero. Texts beyond a slice are
cut at white space and go on in the next one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.shingles import mixed, slices, words
from rowmill.llm.workers import returning_memory
from rowmill.session import ship_package
from rowmill.storage import materialize

SLICE_BYTES = 4 << 20  # text of a slice; there is a range of hashes for every slice or half of one
MOST_STEPS, LEAST_GAIN = 20, 1e-4  # steps of expectation-maximisation, and the gain in log10 per token that is worth another
BUCKETS = 129
UNSEEN, KEPT, DELETED = 0, 1, 2

_BEGIN, _END = np.uint64(0xB5AD4ECEDA1CE2A9), np.uint64(0x8CB92BA72F3D8DD7)
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_ROWS = (
    "slice bigint, range int, fold int, payload binary, tokens bigint, texts bigint, known bigint, known_kept bigint, "
    "doc_ids array<bigint>, parts array<struct<slice:bigint,place:int>>, sizes array<bigint>, going_on boolean"
)
_NAMES = [field.split()[0] for field in _ROWS.split(", ")]


def _pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers as compressed bytes; all lowest bytes come first, then the next ones."""
    values = values.astype(np.uint64)
    if ascending and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return np.int64(len(values)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd"), np.uint8)
    values = np.ascontiguousarray(raw.reshape(8, n).T).reshape(-1).view(np.uint64)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def _join(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _split(data: bytes, n: int) -> list[bytes]:
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.int64, n))]) + 8 * n
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


@dataclass
class Slice:
    """Tokens of some texts: words and an end each. A part of a text starts with the two words before it, which do not count."""

    tokens: np.ndarray
    sizes: np.ndarray  # tokens of each text or part
    going_on: bool  # the first text began in an earlier slice

    def keys(self, bits: int) -> list[np.ndarray]:
        """Hashes of the word, bigram and trigram that end at each token."""
        first, second = self.places()
        before = np.concatenate([[_BEGIN], self.tokens[:-1]])
        before[first] = _BEGIN
        earlier = np.concatenate([[_BEGIN], before[:-1]])
        earlier[first] = _BEGIN
        a, b, c = _FACTORS
        shift = np.uint64(64 - bits)
        return [self.tokens, mixed(self.tokens * a + before * b) >> shift, mixed(self.tokens * a + before * b + earlier * c + b) >> shift]

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Where texts start, and whether a token counts."""
        first = np.cumsum(self.sizes) - self.sizes
        counts = np.ones(len(self.tokens), bool)
        if self.going_on:
            counts[:2] = False
        return first, counts


def _slices_of(batch: pa.RecordBatch, slice_bytes: int) -> Iterator[tuple[int, int, list[int], Slice, bool]]:
    """Fold, first row, rows, tokens, and whether the last text ends here."""
    folds = np.asarray(batch.column(2))
    for fold in np.unique(folds):
        rows = np.flatnonzero(folds == fold)
        texts = pc.fill_null(batch.column(1), "").take(pa.array(rows))
        for begin, end in slices(texts, slice_bytes):
            part = texts.slice(begin, end - begin)
            if end - begin == 1 and len(text := part[0].as_py().encode()) > 2 * slice_bytes:
                yield from ((int(fold), rows[begin:end].tolist(), *piece) for piece in _pieces(text, slice_bytes))
                continue
            h, at = words(part)
            tokens = np.full(len(h) + len(part), _END)
            tokens[np.arange(len(h)) + np.repeat(np.arange(len(part)), np.diff(at))] = h
            yield int(fold), rows[begin:end].tolist(), Slice(tokens, np.diff(at) + 1, False), True


def _pieces(text: bytes, slice_bytes: int) -> Iterator[tuple[Slice, bool]]:
    """One long text in parts that end at white space."""
    at, before = 0, np.array([_BEGIN, _BEGIN])
    while at < len(text):
        end = at + slice_bytes
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        h, _ = words(pa.array([text[at:end]], pa.binary()).cast(pa.string()))
        tokens = np.concatenate([before if at else before[:0], h, np.full(int(end >= len(text)), _END)])
        yield Slice(tokens, np.array([len(tokens)]), at > 0), end >= len(text)
        before, at = np.concatenate([before, h])[-2:], end


def _range_ends(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """How many of the ascending keys lie before the end of each range."""
    return np.searchsorted(keys >> np.uint64(bits - ranges.bit_length() + 1), np.arange(ranges, dtype=np.uint64), "right")


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], schema=_ARROW)


_ARROW = pa.schema([
    ("slice", pa.int64()), ("range", pa.int32()), ("fold", pa.int32()), ("payload", pa.binary()), ("tokens", pa.int64()), ("texts", pa.int64()),
    ("known", pa.int64()), ("known_kept", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("parts", pa.list_(pa.struct([("slice", pa.int64()), ("place", pa.int32())]))), ("sizes", pa.list_(pa.int64())), ("going_on", pa.bool_()),
])


def _texts(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """Per slice a row with its words, numbered by how often they occur there, and the number of each token's word."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        started = None
        for fold, rows, tokens, ends in _slices_of(batch, slice_bytes):
            started = number if not tokens.going_on else started
            distinct, places, n = np.unique(tokens.tokens, return_inverse=True, return_counts=True)
            order = np.lexsort((distinct, -n))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            yield _row(
                slice=number, range=-1, fold=fold, payload=_join([_pack(distinct[order], True), _pack(rank[places])]), tokens=int(tokens.places()[1].sum()),
                texts=int(ends) + len(rows) - 1, doc_ids=batch.column(0).take(pa.array(rows)).to_pylist(), parts=[{"slice": started, "place": i} for i in range(len(rows))],
                sizes=tokens.sizes.tolist(), going_on=tokens.going_on,
            )
            number += 1


def _read(row: dict) -> Slice:
    distinct, places = _split(row["payload"], 2)
    return Slice(_unpack(distinct, True)[_unpack(places).astype(np.int64)], np.array(row["sizes"], np.int64), row["going_on"])


def _sent(batches: Iterator[pa.RecordBatch], ranges: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per slice and range of hashes a row with the slice's distinct n-grams and their counts."""
    for batch in batches:
        for row in _rows_of(batch):
            tokens = _read(row)
            _, counting = tokens.places()
            found = []
            for order, keys in enumerate(tokens.keys(bits)):
                keys, at = np.unique(keys, return_inverse=True)
                counts = np.bincount(at, counting, len(keys)) if row["fold"] != UNSEEN else np.zeros(len(keys))
                found.append((keys, counts, np.concatenate([[0], _range_ends(keys, bits if order else 64, ranges)])))
            for r in range(ranges):
                cut = [(keys[ends[r] : ends[r + 1]], counts[ends[r] : ends[r + 1]]) for keys, counts, ends in found]
                if any(len(keys) for keys, _ in cut):
                    yield _row(slice=row["slice"], range=r, fold=row["fold"], payload=_join([p for keys, counts in cut for p in (_pack(keys, True), _pack(counts))]))


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: a batch holds the payloads of many slices, of which one is worked on at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Neighbouring rows with equal values in a column."""
    group: list[dict] = []
    for batch in batches:
        for row in _rows_of(batch):
            if group and group[0][column] != row[column]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, totals over all slices for each slice's n-grams."""
    for group in _groups(batches, "range"):
        parts = [_split(row.pop("payload"), 6) for row in group]
        folds = np.array([row["fold"] for row in group])
        answers: list[list[bytes]] = [[] for _ in group]
        known = known_kept = 0
        for order in range(3):
            keys = [_unpack(p[2 * order], True) for p in parts]
            sizes = [len(k) for k in keys]
            counts = np.concatenate([_unpack(p[2 * order + 1]) for p in parts]).astype(np.float64)
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            del keys
            total = np.bincount(at, counts, len(distinct))
            kept = np.bincount(at, counts * (np.repeat(folds, sizes) == KEPT), len(distinct))
            if order == 0:
                known, known_kept = int((total > 0).sum()), int((kept > 0).sum())
            ends = np.cumsum(sizes)
            for answer, a, b in zip(answers, ends - sizes, ends):
                answer += [_pack(total[at[a:b]]), _pack(kept[at[a:b]])]
        for i, (row, answer) in enumerate(zip(group, answers)):
            yield _row(**{**row, "payload": _join(answer), "known": known if i == 0 else 0, "known_kept": known_kept if i == 0 else 0})


@dataclass(frozen=True)
class Totals:
    """Tokens, texts and distinct words of all training texts, and of those that are kept."""

    tokens: int
    texts: int
    known: int
    kept_tokens: int
    kept_texts: int
    kept_known: int


def _counts(group: list[dict], bits: int, kept: bool, totals: Totals):
    """A slice's texts with what was counted of each token: the n-grams that end there, and their contexts."""
    texts = next(row for row in group if row["range"] < 0)
    tokens = _read(texts)
    answers = [_split(row["payload"], 6) for row in sorted((r for r in group if r["range"] >= 0), key=lambda r: r["range"])]
    found = []
    for order, keys in enumerate(tokens.keys(bits)):
        keys, at = np.unique(keys, return_inverse=True)
        known = np.concatenate([_unpack(a[2 * order + kept]) for a in answers]).astype(np.float64)
        found.append(known[at])
    first, counting = tokens.places()
    contexts = []
    for counts in found[:2]:
        context = np.concatenate([[0], counts[:-1]])
        context[first] = totals.kept_texts if kept else totals.texts
        contexts.append(context)
    return texts, tokens, counting, found, contexts


def _bucket(two: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Power of two of how often the two words before were seen, else (from 64 on) the word before; the last one if neither was."""
    power = lambda n: np.frexp(np.maximum(n, 1))[1] - 1
    return np.where(two > 0, power(two), np.where(one > 0, 64 + power(one), BUCKETS - 1))


def _held_out_counts(batches: Iterator[pa.RecordBatch], bits: int, totals: Totals) -> Iterator[pa.RecordBatch]:
    """Per distinct trigram of a deleted slice: how often it occurs there, and what was counted of it in the kept texts."""
    for group in _groups(batches, "slice"):
        _, tokens, counting, (word, two, three), (one_before, two_before) = _counts(group, bits, True, totals)
        _, at, n = np.unique(tokens.keys(bits)[2][counting], return_index=True, return_counts=True)
        at = np.flatnonzero(counting)[at]
        columns = [_bucket(two_before[at], one_before[at]), three[at], two_before[at], two[at], one_before[at], word[at], n]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["bucket", "c3", "h3", "c2", "h2", "c1", "n"])


def fit_weights(counts: DataFrame, totals: Totals, most_steps: int = MOST_STEPS) -> np.ndarray:
    """Mixture weights (bucket by estimate, longest n-gram first), by expectation-maximisation over all held-out counts.

    Every bucket starts from equal weights and keeps one token's worth of them, so no weight is zero and buckets that were not met are defined.
    """
    estimates = [F.coalesce(F.try_divide("c3", "h3"), F.lit(0.0)), F.coalesce(F.try_divide("c2", "h2"), F.lit(0.0)), F.col("c1") / max(totals.kept_tokens, 1), F.lit(1.0 / (totals.kept_known + 1))]
    table = counts.select("bucket", "n", *[e.alias(f"f{i}") for i, e in enumerate(estimates)])
    weights, best = np.full((BUCKETS, 4), 0.25), -np.inf
    for _ in range(most_steps):
        # weights come as a table of one row per bucket: the plan is the same in every step, so it is compiled once
        known = table.sparkSession.createDataFrame([(b, *map(float, w)) for b, w in enumerate(weights)], "bucket bigint, w0 double, w1 double, w2 double, w3 double")
        mixed_parts = table.join(F.broadcast(known), "bucket").select("bucket", "n", *[(F.col(f"w{i}") * F.col(f"f{i}")).alias(f"p{i}") for i in range(4)])
        shares = mixed_parts.withColumn("p", F.expr("p0 + p1 + p2 + p3"))
        step = shares.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log10("p")).alias("score"), *[F.sum(F.col("n") * F.col(f"p{i}") / F.col("p")).alias(f"s{i}") for i in range(4)]).collect()
        tokens, score = sum(r["n"] for r in step), sum(r["score"] for r in step)
        if not tokens or score / tokens - best < LEAST_GAIN:
            break
        best = score / tokens
        for r in step:
            sums = np.array([r[f"s{i}"] for i in range(4)]) + 0.25
            weights[r["bucket"]] = sums / sums.sum()
    return weights


def _scored(batches: Iterator[pa.RecordBatch], bits: int, totals: Totals, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    n, known = totals.tokens, totals.known
    for group in _groups(batches, "slice"):
        texts, tokens, counting, (word, two, three), (one_before, two_before) = _counts(group, bits, False, totals)
        estimates = [three / np.maximum(two_before, 1), two / np.maximum(one_before, 1), word / max(n, 1), np.full(len(word), 1.0 / (known + 1))]
        chosen = weights[_bucket(two_before, one_before)]
        score = np.log10(sum(chosen[:, i] * e for i, e in enumerate(estimates)))
        base = np.log10((word + 0.1) / (n + 0.1 * (known + 1)))
        starts = np.cumsum(tokens.sizes) - tokens.sizes
        sums = [np.add.reduceat(np.where(counting, x, 0), starts) for x in (counting, word > 0, base, score)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p["slice"] for p in texts["parts"]], pa.int64()), pa.array([p["place"] for p in texts["parts"]], pa.int32()),
                pa.array(texts["doc_ids"], pa.int64()), *[pa.array(s.astype(np.int64)) for s in sums[:2]], *[pa.array(s.astype(np.float64)) for s in sums[2:]],
            ],
            ["slice", "place", "doc_id", "n_tokens", "n_known", "base_score", "score"],
        )


def interpolated_scores(docs: DataFrame, learn: Column, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``; learns from rows where ``learn`` is true.

    Tokens are the lower-cased words and one end per text. ``n_known`` counts those that occur in training texts, ``base_score`` is the
    log10 probability under additive smoothing of word frequencies (0.1, one unknown word), ``score`` that of the interpolated model.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    ranges = 1 << (size // slice_bytes).bit_length()
    bits = min(64, max(32, int(size).bit_length() + 14))
    deleted = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")), F.lit(10)) == 0
    fold = F.when(~F.coalesce(learn, F.lit(False)), UNSEEN).when(deleted, DELETED).otherwise(KEPT)
    numbered = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), fold.cast("int").alias("fold"))
    texts = materialize(numbered.mapInArrow(returning_memory(lambda b: _texts(b, slice_bytes)), _ROWS), "slices")
    sent = texts.mapInArrow(returning_memory(lambda b: _sent(b, ranges, bits)), _ROWS).repartition(ranges, "range").sortWithinPartitions("range", "slice")
    answers = materialize(sent.mapInArrow(returning_memory(_answered), _ROWS), "answers")

    learned, kept = F.col("fold") != UNSEEN, F.col("fold") == KEPT
    sums = [F.sum(F.when(on, F.col(c))) for on in (learned, kept) for c in ("tokens", "texts")]
    tokens, n_texts, kept_tokens, kept_texts = (x or 0 for x in texts.agg(*sums).first())
    known, kept_known = (x or 0 for x in answers.agg(F.sum("known"), F.sum("known_kept")).first())
    totals = Totals(tokens, n_texts, known, kept_tokens, kept_texts, kept_known)

    def by_slice(wanted: Column) -> DataFrame:
        rows = texts.where(wanted).unionByName(answers.where(wanted))
        return rows.repartition(ranges, "slice").sortWithinPartitions("slice", "range")

    counts = "bucket bigint, c3 bigint, h3 bigint, c2 bigint, h2 bigint, c1 bigint, n bigint"
    held_out = materialize(by_slice(F.col("fold") == DELETED).mapInArrow(returning_memory(lambda b: _held_out_counts(b, bits, totals)), counts), "held-out")
    weights = fit_weights(held_out, totals)
    scored = by_slice(F.lit(True)).mapInArrow(
        returning_memory(lambda b: _scored(b, bits, totals, weights)),
        "slice bigint, place int, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.groupBy("slice", "place", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known")], F.lit(totals.tokens).cast("bigint").alias("train_tokens"), *[F.sum(c).alias(c) for c in ("base_score", "score")]).drop("slice", "place")
