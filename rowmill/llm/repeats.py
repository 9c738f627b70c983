"""Repeated byte strings over all documents, by prefix doubling on sampled positions.

A string of ``LENGTH`` (50) bytes is repeated if it also starts in a document with a smaller id. Positions are ranked by the
strings that start there; positions whose rank is unique to one document drop out, the others go on to longer strings:

1. ``FIRST`` (24) bytes, at sampled positions. Of the 27 such strings inside a window of 50 bytes the one with the smallest
   hash stands for the window, so equal windows are always represented by equal strings at equal places. Neighbouring
   windows with one representative form a run, which travels as one row with the rank of its whole text. Spark sorts
   rank and document: a run whose text an earlier document has is repeated, a run whose representative
   only one document has is unique, the rest stays open.
2. 25 bytes and the 25 behind them: the windows of open runs are ranked by the pair of ranks at offset 25 and sorted
   again. A window that an earlier document has is repeated; past the threshold nothing longer is needed.

Ranks are 64-bit hashes. What a slice of texts settles by itself stays out of its rank's group: runs and windows that an earlier
document of the slice has, and runs whose representative has many different surroundings in the slice (these go
straight to step 2; two rows tell the other slices its least and greatest id). Such rows get a group of their own, so
a passage of all documents sends one row per slice to its rank, not one per document. Only texts of one id (null ids, say)
are not earlier for each other and send all their rows.

Edge cases: null and empty texts and texts under 50 bytes have nothing removed and repeat nothing; documents
with equal ids do not count as earlier for each other, whatever their texts (any number of texts under one id is told
apart by a 64-bit hash of the text, used only if some id is repeated); null ids come after all others; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.llm.shingles import _power_table, buffers, mixed, random_words, slices
from rowmill.storage import materialize, release_shuffles

LENGTH = 50
FIRST = 24
HALF = LENGTH // 2
COMMON = 8
SLICE_BYTES = 2 << 20
SLICE_WINDOWS = 1 << 19
_BYTE = random_words(256, 9)
_LAST = (1 << 63) - 1
_INDEX = np.uint64((1 << 32) - 1)
_TURN = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """Hashes of any strings of one array of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_table(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def everywhere(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def windows(self, begin: np.ndarray) -> np.ndarray:
        """Rank pairs at offset ``HALF``, as one number."""
        return mixed(self.of(begin, begin + HALF) * _TURN + self.of(begin + HALF, begin + LENGTH))


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows: rank of the representative, rank of the run's text, row, first window, windows."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    ranks = Ranks(data)
    short = ranks.everywhere(FIRST)
    # The smallest hash over a sliding window by doubling; the place in the low bits prefers the first of equals.
    least = (short & ~_INDEX) | np.arange(len(short), dtype=np.uint64)
    span, wide = 1, LENGTH - FIRST + 1
    while span < wide:
        step = min(span, wide - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    at = (least & _INDEX).astype(np.int64)
    inside = np.ones(len(at), bool)
    for end in offsets[1:-1]:
        inside[max(0, end - LENGTH + 1) : min(end, len(at))] = False
    begin = np.flatnonzero(inside)
    if not len(begin):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    chosen = at[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(begin)))
    start, place = begin[first], chosen[first]
    text = ranks.of(start, start + count + LENGTH - 1)
    text = mixed(text + (place - start).astype(np.uint64) * _TURN + count.astype(np.uint64))
    return short[place], text, np.searchsorted(offsets, start, "right") - 1, start, count


OPEN, DONE, SEEN = 0, 1, 2
# ``place`` packs, from the high end, the first window, the windows, the state. ``copy`` tells texts of equal id apart.
RUN_SCHEMA = "rank long, whole long, id long, copy long, place long"
RUN_NAMES = ["rank", "whole", "id", "copy", "place"]
FIRST_BIT, WINDOWS_BIT = 10, 2


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids_of, copies_of = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for low, high in slices(batch.column(2), SLICE_BYTES):
            data, offsets = buffers(batch.column(2).slice(low, high - low))
            rank, whole, row, start, count = runs(data, offsets)
            ids = ids_of[low:high][row]
            order = np.lexsort((ids, whole, rank))
            rank, whole, row, start, count, ids = (x[order] for x in (rank, whole, row, start, count, ids))
            if not len(rank):
                continue
            new_whole = np.append(True, (whole[1:] != whole[:-1]) | (rank[1:] != rank[:-1]))
            new_rank = np.append(True, rank[1:] != rank[:-1])
            group, kind = np.cumsum(new_whole) - 1, np.cumsum(new_rank) - 1
            state = np.where(ids > ids[new_whole][group], DONE, OPEN)
            different = np.bincount(kind[new_whole])[kind]
            state = np.where((state == OPEN) & (different > COMMON), SEEN, state)
            place = (start - offsets[row]) << FIRST_BIT | count << WINDOWS_BIT | state
            group_of = np.where(state == OPEN, rank, _own_group(rank, ids, copies_of[low:high][row], start - offsets[row]))
            columns = [group_of.view(np.int64), whole.view(np.int64), ids, copies_of[low:high][row], place]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], RUN_NAMES)
            # Two rows tell the other slices that the representative is common, and the least and greatest id that has it.
            common = different > COMMON
            told = np.flatnonzero(new_rank & common)
            if len(told):
                ids_told = np.concatenate([np.minimum.reduceat(ids, np.flatnonzero(new_rank)), np.maximum.reduceat(ids, np.flatnonzero(new_rank))])
                ids_told = ids_told[np.tile(common[new_rank], 2)]
                n = 2 * len(told)
                columns = [np.tile(rank[told], 2).view(np.int64), np.zeros(n, np.int64), ids_told, np.zeros(n, np.int64), np.full(n, OPEN)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], RUN_NAMES)


def _own_group(rank: np.ndarray, ids: np.ndarray, copies: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A group for each row, by rank and place."""
    return mixed(rank + ids.view(np.uint64) * _TURN + mixed(copies.astype(np.int64).view(np.uint64) + first.astype(np.uint64)))


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank, document and first byte of open windows; a window that an earlier document of the slice has is ``~first`` and a group of its own."""
    parts: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint8)
            packed = np.unique(batch.column(3)[i].values.to_numpy())
            first, count = packed >> 8, packed & 255
            begin = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            for part in np.array_split(begin, max(1, len(begin) // SLICE_WINDOWS)):
                doc = [np.full(len(part), batch.column(j)[i].as_py(), np.int64) for j in (0, 1)]
                parts.append((_ranked(data, part), *doc, part.astype(np.int64)))
                size += len(part)
                if size >= SLICE_WINDOWS:
                    yield _settled(parts)
                    parts, size = [], 0
    if parts:
        yield _settled(parts)


def _settled(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    rank, ids, copies, first = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((ids, rank))
    rank, ids, copies, first = rank[order], ids[order], copies[order], first[order]
    new = np.append(True, rank[1:] != rank[:-1])[: len(rank)]
    done = ids > ids[new][np.cumsum(new) - 1]
    group = np.where(done, _own_group(rank, ids, copies, first), rank)
    columns = [group.view(np.int64), ids, copies, np.where(done, ~first, first)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rank", "id", "copy", "first"])


def _ranked(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Ranks of windows of one text, from the part of the text that holds them."""
    low = int(begin[0])
    return Ranks(data[low : int(begin[-1]) + LENGTH]).windows(begin - low)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = text.as_buffer().to_pybytes() if text.is_valid and len(text.as_buffer() or b"") else b""
            spans, kept = [], [data]
            if marks.is_valid:
                packed = np.sort(marks.values.to_numpy())
                first, end = packed >> 8, (packed >> 8) + (packed & 255) + LENGTH - 1
                reach = np.maximum.accumulate(end)
                opens = np.append(True, first[1:] > reach[:-1])
                spans = list(zip(first[opens].tolist(), reach[np.append(opens[1:], True)].tolist()))
                edges = [0, *[x for s in spans for x in s], len(data)]
                kept = [data[a:b] for a, b in zip(edges[::2], edges[1::2])]
            left = b"".join(kept)
            rows.append((doc_id, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(), [list(s) for s in spans]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kinds[j]) for j in range(6)], names)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (begin and end bytes removed)."""
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.lit(0).cast("long").alias("copy"), "text")
    if not texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        texts = texts.withColumn("copy", F.xxhash64("text"))
    part = lambda low, bits: F.shiftright("place", low).bitwiseAND(F.lit((1 << bits) - 1))
    first, windows_of, state = F.shiftright("place", FIRST_BIT), part(WINDOWS_BIT, 8), part(0, 2)
    found = texts.select("id", "copy", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_run_rows, RUN_SCHEMA)
    by_whole, by_rank = Window.partitionBy("rank", "whole"), Window.partitionBy("rank")
    earlier = F.min(F.when(state != SEEN, F.col("id"))).over(by_whole)
    sorted_runs = (
        found.repartition("rank")
        .withColumn("done", (state == DONE) | ((state == OPEN) & (windows_of > 0) & (F.col("id") > earlier)))
        .withColumn("low", F.min("id").over(by_rank))
        .withColumn("high", F.max("id").over(by_rank))
        .withColumn("apart", F.min("whole").over(by_rank) != F.max("whole").over(by_rank))
    )
    still = (state == SEEN) | ((F.col("low") < F.col("high")) & F.col("apart"))
    known = materialize(sorted_runs.where((windows_of > 0) & (F.col("done") | still)).select("id", "copy", (F.shiftleft(first, 8) + windows_of).alias("run"), "done"), "runs")
    release_shuffles(docs.sparkSession)
    open_runs = known.where("not done").groupBy("id", "copy").agg(F.collect_list("run").alias("runs"))
    shown = texts.where("text is not null").select("id", "copy", F.col("text").cast("binary").alias("text")).join(open_runs.hint("merge"), ["id", "copy"])
    windows = shown.select("id", "copy", "text", "runs").mapInArrow(_window_rows, "rank long, id long, copy long, first long")
    same = Window.partitionBy("rank")
    again = windows.withColumn("low", F.min("id").over(same)).where("first < 0 OR id > low")
    place = F.when(F.col("first") < 0, F.bitwise_not("first")).otherwise(F.col("first"))
    again = materialize(again.select("id", "copy", (F.shiftleft(place, 8) + 1).alias("run")), "windows")
    release_shuffles(docs.sparkSession)
    marks = known.where("done").select("id", "copy", "run").unionByName(again).groupBy("id", "copy").agg(F.collect_list("run").alias("runs"))
    rows = texts.select("doc_id", "id", "copy", F.col("text").cast("binary").alias("text")).join(marks.hint("merge"), ["id", "copy"], "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return rows.select("doc_id", "text", "runs").mapInArrow(_cut, schema)
