"""Runs of words that repeat with a period, caught online by dyadic blocks.

``SquareCatcher`` reads a sequence of words as it is appended. Whenever a block of a power of two words is complete, a
catcher for it watches the words that follow: a block of b words for a second occurrence 2b to 4b - 1 words further on
(that of 4 words for one at 1 to 3 words, too). A square with words of that length holds such a block whole in its first
half, so no square is missed. An occurrence starts a comparison of the suffixes that end in block and occurrence:
it is carried back to the first difference, and every appended word carries it forward. It reports a square once as many
words agree as its period has; squares of one period that overlap merge into one run. Comparisons that reach the last word stay
open. Among comparisons over the same stretch the smallest period is kept: longer ones are its multiples.

All catchers of one block size are advanced together over the words of one ``append`` (NumPy); results do not depend
on how the words are cut into appends. Blocks are compared by hashes modulo 2^61 - 1, so equality is up to collisions. A
word costs one hash per block size, a caught block a logarithmic number of comparisons, however repetitive the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.shingles import slices
from rowmill.session import ship_package

SHORTEST = 12  # words of the shortest run
APPENDED = 1 << 18  # words per append of a long text
SLICE_BYTES = 2 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)
_BASE = 0x1B8F2D3A5C6E7091
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_S31, _S30, _S61 = np.uint64(31), np.uint64(30), np.uint64(61)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo 2^61 - 1 of numbers below it, from 31-bit halves."""
    ah, al, bh, bl = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    middle = ah * bl + al * bh
    return _reduced(((ah * bh) << np.uint64(1)) + (middle >> _S30) + ((middle & _LOW30) << _S31) + al * bl)


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + _P - b)


class _Powers:
    """Powers of a base, computed by doubling as far as asked for."""

    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = np.uint64(pow(self.base, len(self.known), _PRIME))
            self.known = np.concatenate([self.known, _times(self.known, step)])
        return self.known


class SquareCatcher:
    """The runs of a growing sequence of words, given as 64-bit hashes (or any distinct numbers)."""

    def __init__(self, shortest: int = SHORTEST):
        if shortest < SHORTEST:
            raise ValueError(f"blocks of 4 words catch short periods in runs of {SHORTEST} words on")
        self.shortest = shortest
        self.up, self.down = _Powers(_BASE), _Powers(pow(_BASE, -1, _PRIME))
        self.n = 0
        self._sums = np.zeros(1, np.uint64)
        self.closed: list[np.ndarray] = []
        self.open = np.zeros((0, 2), np.int64)  # start and period of comparisons that reach the last word

    @property
    def sums(self) -> np.ndarray:
        return self._sums[: self.n + 1]

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        before = self.n
        self._extend(_reduced(words.astype(np.uint64)))
        found = [self._compare(self.open)]
        levels = [1 << k for k in range(1, max(2, (self.n // 3).bit_length() - 1) + 1)]  # longer blocks still wait
        for b, distances in [(4, (1, 2, 3)), *[(b, ()) for b in levels]]:
            if b < self.n:
                caught = self._catch(b, before, distances)
                found.append(self._compare(self._unexplained(caught, b, np.concatenate(found))))
        start, end, period = np.concatenate(found).T
        long = end - start >= np.maximum(self.shortest, 2 * period)
        still = end == self.n
        self.closed.append(_smallest_periods(start, end, period, long & ~still))
        self.open = self._kept_open(start[still], period[still])

    def runs(self) -> np.ndarray:
        """Rows of start, length and smallest period, by start, then period."""
        start, period = self.open[:, 0], self.open[:, 1]
        long = self.n - start >= np.maximum(self.shortest, 2 * period)
        rows = np.concatenate([*self.closed, np.stack([start, np.full(len(start), self.n), period], axis=1)[long]])
        rows = _smallest_periods(*rows.T)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        return np.stack([rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)

    def _extend(self, words: np.ndarray) -> None:
        n = self.n + len(words)
        self.up.upto(n + 1), self.down.upto(n + 1)
        terms = _times(words, self.up.known[self.n : n])
        high, low = np.cumsum(terms >> _S31, dtype=np.uint64), np.cumsum(terms & _LOW31, dtype=np.uint64)
        added = _times(_reduced(high), np.uint64(1 << 31)) + _reduced(low)
        if len(self._sums) < n + 1:
            self._sums = np.concatenate([self.sums, np.zeros(max(n, 2 * self.n) - self.n, np.uint64)])
        self._sums[self.n + 1 : n + 1] = _reduced(added + self._sums[self.n])
        self.n = n

    def _hashes(self, at: np.ndarray | slice, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each place, equal for equal words."""
        if isinstance(at, slice):
            ends = slice(at.start + width, at.stop + width, at.step)
            return _times(_minus(self.sums[ends], self.sums[at]), self.down.known[at])
        return _times(_minus(self.sums[at + width], self.sums[at]), self.down.known[at])

    def _catch(self, b: int, before: int, distances: tuple[int, ...] = ()) -> np.ndarray:
        """Block and distance of second occurrences that the new words complete: at 2b to 4b - 1 words, or the given distances."""
        low, high = max(0, before - b + 1), self.n - b + 1  # windows that end in the new words
        first = max(0, low // b - 4)
        blocks = self._hashes(slice(first * b, high, b), b)
        windows = self._hashes(slice(low, high, 1), b)
        place = np.arange(low, high)
        found = [np.zeros((0, 2), np.int64)]
        for back in () if distances else (2, 3):
            at = np.flatnonzero(place >= back * b)
            block = place[at] // b - back
            hit = windows[at] == blocks[block - first]
            found.append(np.stack([block * b, place[at] - block * b], axis=1)[hit])
        for distance in distances:
            at = np.flatnonzero((place >= distance) & ((place - distance) % b == 0))
            at = at[windows[at] == blocks[(place[at] - distance) // b - first]]
            found.append(np.stack([place[at] - distance, np.full(len(at), distance)], axis=1))
        return np.concatenate(found)

    def _equal(self, a: np.ndarray, b: np.ndarray, distance: np.ndarray, width: np.ndarray) -> np.ndarray:
        left = _times(_minus(self.sums[a + width], self.sums[a]), self.up.known[distance])
        return left == _minus(self.sums[b + width], self.sums[b])

    def _unexplained(self, caught: np.ndarray, b: int, found: np.ndarray) -> np.ndarray:
        """What is caught, but for places inside a known run whose period divides the distance: it would be found again."""
        long = found[:, 1] - found[:, 0] >= np.maximum(self.shortest, 2 * found[:, 2])
        runs = _smallest_periods(*found.T, long)
        if not len(runs) or not len(caught):
            return caught
        ends = np.maximum.accumulate(runs[:, 1])
        furthest = np.maximum.accumulate(np.where(ends == runs[:, 1], np.arange(len(runs)), 0))
        at = np.searchsorted(runs[:, 0], caught[:, 0], "right") - 1
        run = runs[furthest[np.maximum(at, 0)]]
        inside = (at >= 0) & (caught[:, 0] + caught[:, 1] + b <= run[:, 1])
        return caught[~(inside & (caught[:, 1] % run[:, 2] == 0))]

    def _compare(self, caught: np.ndarray) -> np.ndarray:
        """The whole stretch around each place in which words a period apart agree: start, end, period."""
        at, period = caught[:, 0], caught[:, 1]
        back, forth = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        room = self.n - at - period
        step = 1 << max(0, self.n.bit_length() - 1) if len(at) else 0
        while step:
            longer = back + step
            ok = np.flatnonzero(longer <= at)
            ok = ok[self._equal((at - longer)[ok], (at + period - longer)[ok], period[ok], longer[ok])]
            back[ok] = longer[ok]
            longer = forth + step
            ok = np.flatnonzero(longer <= room)
            ok = ok[self._equal(at[ok], (at + period)[ok], period[ok], longer[ok])]
            forth[ok] = longer[ok]
            step //= 2
        return np.stack([at - back, at + period + forth, period], axis=1)

    def _kept_open(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Open comparisons without those that stand or fall with a smaller period over the same stretch."""
        rows = np.unique(np.stack([start, period], axis=1), axis=0)  # by start, then period
        if not len(rows):
            return rows
        first = np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])
        smallest = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0)), 1]
        return rows[first | (self.n - rows[:, 0] < smallest + rows[:, 1])]


def _smallest_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """Distinct stretches, of the chosen ones, as rows of start, end and smallest period, by start, then end."""
    rows = np.stack([start, end, period], axis=1)
    rows = rows if chosen is None else rows[chosen]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])] if len(rows) else rows


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[np.ndarray]:
    """Runs of every text's words. The texts are read one after the other, with a mark of its own between two."""
    counts = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(counts + 1)])
    words = np.zeros(begins[-1], np.int64)
    marks = begins[1:] - 1
    words[marks] = [hash((b"end of text", i)) for i in range(len(texts))]
    for begin, text in zip(begins, texts):
        words[begin : begin + len(text)] = np.fromiter(map(hash, text), np.int64, len(text))
    catcher = SquareCatcher(shortest)
    for at in range(0, len(words), APPENDED):
        catcher.append(words[at : at + APPENDED])
    found = catcher.runs()
    cuts = np.searchsorted(found[:, 0], begins)
    return [found[a:b] - [begin, 0, 0] for a, b, begin in zip(cuts[:-1], cuts[1:], begins)]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words outside the repeating part (all but the first period) of every run."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(steps[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


def word_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id, runs, collapsed``: maximal runs of words by start, then period, and the words kept, joined by one space.

    A run is a stretch of at least ``shortest`` words and two smallest periods that no neighbouring word extends. Words are runs of
    characters other than the six ASCII white space ones. Works text by text, so no row is shuffled. A null text is an empty one;
    an empty text has no runs. Null and repeated ids are kept, a row each; other columns are not read. Long texts are appended in parts;
    a task holds some hundred bytes per word of its longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            for begin, end in slices(texts, SLICE_BYTES):
                words = [t.split() for t in texts.slice(begin, end - begin).to_pylist()]
                found = runs_of(words, shortest)
                kept = [b" ".join(collapsed(w, r) if len(r) else w) for w, r in zip(words, found)]
                ends = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                fields = [pa.array(f) for f in np.concatenate([*found, np.zeros((0, 3), np.int64)]).T.copy()]
                runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"])).cast(kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, f"doc_id bigint, runs {RUNS}, collapsed string")
