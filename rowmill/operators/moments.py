"""Counts, means, squares and products about the mean: the one pass behind scalings, correlations and regressions.

Each task turns its Arrow batches into one small state; states are merged by the parallel update formula (Chan,
Golub and LeVeque): first by several tasks, each for a share of the states, then on the driver for ``MERGERS`` of them.
Means are kept instead of sums, so large offsets cost no digits, a constant column has a spread of exactly zero, and
the result does not depend on the number of columns or the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.session import ship_package

MERGERS = 16
BLOCK = 128  # columns of a block
STATE_BYTES = 128 << 20  # states of block pairs that a task holds at a time
States = dict[int, np.ndarray]


PAIR_SCHEMA = "i int, j int, n double, correlation double"


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])


def _merged(states: Iterator[tuple[int, np.ndarray]], merge: Callable) -> States:
    total: States = {}
    for key, state in states:
        total[key] = merge(total[key], state) if key in total else state
    return total


def over_tasks(df: DataFrame, height: int, partial: Callable[[np.ndarray], States], merge: Callable) -> States:
    """Merge the states that ``partial`` finds per batch, by their integer key. A state is an array with ``height`` rows."""

    def batch_of(total):
        values = pa.array([state.ravel() for state in total.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), values], ["key", "state"])

    def states_of(batches):
        for b in batches:
            for key, state in zip(b.column(0).to_pylist(), b.column(1)):
                yield key, state.values.to_numpy().reshape(height, -1)

    def first(batches):
        matrices = (np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows)
        yield batch_of(_merged((item for x in matrices for item in partial(x).items()), merge))

    def second(batches):
        yield batch_of(_merged(states_of(batches), merge))

    ship_package(df.sparkSession)
    schema = "key bigint, state array<double>"
    parts = df.mapInArrow(first, schema).repartition(MERGERS).mapInArrow(second, schema)
    rows = ((row["key"], np.array(row["state"], dtype="float64").reshape(height, -1)) for row in parts.collect())
    return _merged(rows, merge)


# Rows of a pair state: rows with both values, mean and squares of either, products; all about the means.
N, MEAN_A, MEAN_B, SQUARES_A, SQUARES_B, PRODUCTS = range(6)


def merge_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = b[0] / np.where(n > 0, n, 1.0)
    both = a[0] * share
    da, db = np.where(b[0] > 0, b[1] - a[1], 0.0), np.where(b[0] > 0, b[2] - a[2], 0.0)
    mean_a, mean_b = np.where(a[0] > 0, a[1] + da * share, b[1]), np.where(a[0] > 0, a[2] + db * share, b[2])
    da, db = np.where(both > 0, da, 0.0), np.where(both > 0, db, 0.0)
    return np.stack([n, mean_a, mean_b, a[3] + b[3] + da * da * both, a[4] + b[4] + db * db * both, a[5] + b[5] + da * db * both])


def _pair_states(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """State of each column of ``x`` with the same column of ``y``; NaN counts as missing."""
    both = ~(np.isnan(x) | np.isnan(y))
    n = both.sum(axis=0).astype("float64")
    at = both.argmax(axis=0), np.arange(x.shape[1])
    with np.errstate(invalid="ignore", over="ignore"):
        # Shifted by a value of the column, so a constant column stays exactly constant.
        first_x, first_y = np.where(n > 0, x[at], 0.0), np.where(n > 0, y[at], 0.0)
        zx, zy = np.where(both, x - first_x, 0.0), np.where(both, y - first_y, 0.0)
        mx, my = zx.sum(axis=0) / np.maximum(n, 1), zy.sum(axis=0) / np.maximum(n, 1)
        zx, zy = np.where(both, zx - mx, 0.0), np.where(both, zy - my, 0.0)
        return np.stack([n, first_x + mx, first_y + my, (zx * zx).sum(axis=0), (zy * zy).sum(axis=0), (zx * zy).sum(axis=0)])


def column_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    """Row count, values, mean and population deviation per column; NaN counts as missing.

    With an infinite value the mean is infinite or NaN and the deviation NaN.
    """
    def partial(x):
        rows = np.zeros((6, 1))
        rows[0] = len(x)
        return {0: _pair_states(x, x), 1: rows}

    found = over_tasks(_doubles(df, columns), 6, partial, merge_pairs)
    state = found.get(0, np.zeros((6, len(columns))))
    rows = int(found[1][0, 0]) if 1 in found else 0
    result = {}
    for i, name in enumerate(columns):
        n, mean, squares = state[N, i], state[MEAN_A, i], state[SQUARES_A, i]
        result[name] = {"rows": rows, "n": int(n), "mean": float(mean) if n else None, "std": float(np.sqrt(squares / n)) if n else None}
    return result


@dataclass(frozen=True)
class PairMoments:
    """For pairs of columns, over the rows where both are present: the rows of a pair state, each as a k×k array."""

    n: np.ndarray
    squares: np.ndarray  # of column i in the rows of pair (i, j)
    products: np.ndarray

    def correlations(self) -> np.ndarray:
        """Pearson matrix with pairwise-complete rows; NaN where a column does not vary."""
        with np.errstate(invalid="ignore"):
            spread = np.sqrt(np.where(self.squares > 0, self.squares, np.nan))
            return np.clip(self.products / (spread * spread.T), -1.0, 1.0)


def pair_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    """Moments of every pair of columns in one pass; the result is k×k on the driver, for a few hundred columns (else ``pair_table``)."""
    k = len(columns)

    def partial(x):
        present = ~np.isnan(x)
        count = present.sum(axis=0)
        with np.errstate(invalid="ignore", over="ignore"):
            first = np.where(count > 0, x[present.argmax(axis=0), np.arange(k)], 0.0)
            z = np.where(present, x - first, 0.0)
            middle = z.sum(axis=0) / np.maximum(count, 1)
            z = np.where(present, z - middle, 0.0)
            centre = first + middle
            mask = present.astype("float64")
            n = mask.T @ mask
            safe = np.maximum(n, 1)
            mean = (z.T @ mask) / safe  # of column i about its centre, in the rows of pair (i, j)
            squares = np.maximum((z * z).T @ mask - n * mean * mean, 0.0)
            products = z.T @ z - n * mean * mean.T
        return {i: np.stack([n[i, i:], centre[i] + mean[i, i:], centre[i:] + mean[i:, i], squares[i, i:], squares[i:, i], products[i, i:]]) for i in range(k)}

    found = over_tasks(_doubles(df, columns), 6, partial, merge_pairs)
    n, squares, products = np.zeros((k, k)), np.zeros((k, k)), np.zeros((k, k))
    for i, state in found.items():
        n[i, i:] = n[i:, i] = state[N]
        products[i, i:] = products[i:, i] = state[PRODUCTS]
        squares[i, i:], squares[i:, i] = state[SQUARES_A], state[SQUARES_B]
    return PairMoments(n, squares, products)


class Centred(NamedTuple):
    """A batch of a block of columns: values about a centre per column (0 where missing), with their sums and squares."""

    mask: np.ndarray | None  # 1 where there is a value; None if there are all
    centre: np.ndarray
    z: np.ndarray
    sums: np.ndarray
    squares: np.ndarray


def _centred(x: np.ndarray) -> Centred:
    mask = None
    with np.errstate(invalid="ignore", over="ignore"):
        first = x[0] if len(x) else np.zeros(x.shape[1])
        z = x - first
        middle = z.sum(axis=0) / max(len(x), 1)
        if np.isfinite(middle).all():
            z -= middle
        else:  # values are missing, or infinite
            present = ~np.isnan(x)
            count = present.sum(axis=0)
            first = np.where(count > 0, x[present.argmax(axis=0), np.arange(x.shape[1])], 0.0)
            z = np.where(present, x - first, 0.0)
            middle = z.sum(axis=0) / np.maximum(count, 1)
            mask, z = present.astype("float64"), np.where(present, z - middle, 0.0)
        return Centred(mask, first + middle, z, z.sum(axis=0), np.einsum("ij,ij->j", z, z))


def _block_state(a: Centred, b: Centred) -> np.ndarray:
    """State of every column of one block with every column of another, over the rows where both are present.

    Where a block misses nothing, its columns have the same rows with any other, and sums take the place of products with its mask.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        if a.mask is None:
            n = np.full(b.z.shape[1], float(len(b.z))) if b.mask is None else b.mask.sum(axis=0)
            sums_b, squares_b = b.sums, b.squares
        else:
            n = a.mask.sum(axis=0)[:, None] if b.mask is None else a.mask.T @ b.mask
            sums_b, squares_b = a.mask.T @ b.z, a.mask.T @ (b.z * b.z)
        if b.mask is None:
            sums_a, squares_a = a.sums[:, None], a.squares[:, None]
        else:
            sums_a, squares_a = a.z.T @ b.mask, (a.z * a.z).T @ b.mask
        safe = np.maximum(n, 1)
        mean_a, mean_b = sums_a / safe, sums_b / safe
        squares_a, squares_b = np.maximum(squares_a - n * mean_a * mean_a, 0.0), np.maximum(squares_b - n * mean_b * mean_b, 0.0)
        state = np.empty((6, a.z.shape[1], b.z.shape[1]))
        for row, values in enumerate([n, a.centre[:, None] + mean_a, b.centre + mean_b, squares_a, squares_b, a.z.T @ b.z - n * mean_a * mean_b]):
            state[row] = values
    return state.reshape(6, -1)


def pair_table(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """``i, j, n, correlation`` for every pair of columns (and each with itself), by position; null where one does not vary.

    States are kept per pair of column blocks, merged inside tasks, then by (block pair, part), then by block pair: neither the driver nor
    a merging task holds all pairs. A task holds ``STATE_BYTES`` of them at a time: wider tables are read once per that many block pairs,
    each time only the columns in question.
    """
    starts = range(0, len(columns), block)
    pairs = [(a, b) for a in starts for b in starts if a <= b]
    together = max(1, STATE_BYTES // (48 * block * block))
    parts = [_pairs_of_blocks(df, columns, pairs[at : at + together], block) for at in range(0, len(pairs), together)]
    if not parts:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _pairs_of_blocks(df: DataFrame, columns: Sequence[str], pairs: list[tuple[int, int]], block: int) -> DataFrame:
    used = sorted({start for pair in pairs for start in pair})
    width = {start: min(block, len(columns) - start) for start in used}
    at = dict(zip(used, np.cumsum([0, *[width[s] for s in used]]).tolist()))
    sides = {number: pair for number, pair in enumerate(pairs)}

    def batch_of(number: int, part: int, state: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([part]), pa.array([state.ravel()], pa.list_(pa.float64()))], ["pair", "part", "state"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: States = {}
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            part = batch.column(1)[0].as_py() % MERGERS
            sliced = {s: _centred(x[:, at[s] : at[s] + width[s]]) for s in used}
            for number, (a, b) in sides.items():
                state = _block_state(sliced[a], sliced[b])
                total[number] = merge_pairs(total[number], state) if number in total else state
        for number, (a, b) in sides.items():
            yield batch_of(number, part, total.pop(number) if number in total else np.zeros((6, width[a] * width[b])))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        states = ((number, state.values.to_numpy().reshape(6, -1)) for b in batches for number, state in zip(b.column(0).to_pylist(), b.column(2)))
        yield from _merged(states, merge_pairs).items()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, state in merged(batches):
            yield batch_of(number, 0, state)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, state in merged(batches):
            a, b = sides[number]
            i, j = (x.ravel() for x in np.meshgrid(np.arange(width[a]) + a, np.arange(width[b]) + b, indexing="ij"))
            with np.errstate(invalid="ignore", divide="ignore"):
                varies = (state[SQUARES_A] > 0) & (state[SQUARES_B] > 0)
                r = np.where(varies, np.clip(state[PRODUCTS] / (np.sqrt(state[SQUARES_A]) * np.sqrt(state[SQUARES_B])), -1.0, 1.0), np.nan)
            upper = i <= j
            found = pa.array(r[upper], mask=np.isnan(r[upper]))
            yield pa.RecordBatch.from_arrays([pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), pa.array(state[N][upper]), found], ["i", "j", "n", "correlation"])

    ship_package(df.sparkSession)
    schema = "pair bigint, part bigint, state array<double>"
    chosen = [c for s in used for c in columns[s : s + width[s]]]
    # One array a row: Spark writes it in one piece, where columns would be written value by value to as many places.
    # The part is not deterministic, which keeps the columns' own expressions out of the array's: together they outgrow a compiled method.
    doubles = _doubles(df, chosen).withColumn("part", F.spark_partition_id())
    states = doubles.select(F.array(*[f"x{i}" for i in range(len(chosen))]).alias("x"), "part").mapInArrow(first, schema)
    by_part = states.repartition("pair", "part").mapInArrow(second, schema)
    return by_part.repartition("pair").mapInArrow(rows, PAIR_SCHEMA)


def correlations_with(df: DataFrame, columns: Sequence[str], other: str) -> list[float]:
    """Correlation of each column with one ``other``, in one pass of linear cost; NaN where one does not vary."""
    def partial(x):
        return {0: _pair_states(x[:, :-1], np.broadcast_to(x[:, -1:], x[:, :-1].shape))}

    found = over_tasks(_doubles(df, [*columns, other]), 6, partial, merge_pairs)
    state = found.get(0, np.zeros((6, len(columns))))
    with np.errstate(invalid="ignore", divide="ignore"):
        r = state[PRODUCTS] / np.sqrt(state[SQUARES_A] * state[SQUARES_B])
    return [float(x) for x in np.clip(np.where((state[SQUARES_A] > 0) & (state[SQUARES_B] > 0), r, np.nan), -1.0, 1.0)]


def grouped_products(df: DataFrame, columns: Sequence[Column], group: Column) -> States:
    """Per integer group, the (k+1)×(k+1) product sums of (1, columns): counts, sums and products."""
    k = len(columns)
    wide = df.select(group.cast("double").alias("g"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def partial(x):
        groups = x[:, 0].copy()
        x[:, 0] = 1.0
        return {int(g): x[groups == g].T @ x[groups == g] for g in np.unique(groups)}

    return over_tasks(wide, k + 1, partial, lambda a, b: a + b)
