"""Exact medians and percentiles without ever holding a large column in one task.

Spark's ``percentile`` keeps a value-to-count map of the column in a single aggregation buffer: right
for a column with few distinct values, fatal for one with billions. Here two passes over the table serve all columns and all ranks:

1. A mergeable sketch per column gives values at evenly spaced shares. Its error is below the spacing, so the grid brackets any rank.
2. Values inside a bracket are counted one by one, those between brackets together. Running counts place every rank exactly.

Ranks can be chosen after the first pass (``RankSketch``), so quantiles of values that keep the column's order come
from the same two passes. A hot value is one counted value, however many rows have it. Where brackets of a very long column would hold
too many values (or a rank lies outside its bracket), pivots narrow them first: each pass leaves about a thousandth, and counts decide, so the
answer is exact whatever the sketch's error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.columns import numeric_columns

FEW_VALUES = 100_000  # distinct values that fit one aggregation buffer or one group with ease
FEW_CANDIDATES = 5_000_000  # values in a column's brackets, ordered by one task
GRID = 400  # shares at which the sketch is read; their spacing is five times its error
SKETCH_ACCURACY = 2_000  # a pivot's rank is off by about 1/2000 of its interval


@dataclass
class _Interval:
    """Open interval of one column with the wanted 0-based ranks known to lie inside it."""

    column: str
    ranks: list[int]
    below: int
    rows: int
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        x = F.col(self.column)
        inside = x.isNotNull()
        if self.low is not None:
            inside &= x > self.low
        if self.high is not None:
            inside &= x < self.high
        return inside


class RankSketch:
    """Number of values and values near evenly spaced ranks of each column, in one pass; exact values by rank in a second one.

    ``extra`` aggregates of ``df`` come with the first pass, as ``extra[name]``.
    """

    def __init__(self, df: DataFrame, columns: Mapping[str, Column], extra: Mapping[str, Column] | None = None):
        numbers = [column.cast("double") for column in columns.values()]
        self.columns = list(columns)
        self.narrow = df.select(*[F.when(~F.isnan(x), x).alias(f"v{i}") for i, x in enumerate(numbers)])
        shares = [k / GRID for k in range(GRID + 1)]
        both = df.select(*[F.when(~F.isnan(x), x).alias(f"v{i}") for i, x in enumerate(numbers)], *[c.alias(f"e{i}") for i, c in enumerate((extra or {}).values())])
        row = both.agg(
            *[F.count(v).alias(f"n_{v}") for v in self.narrow.columns],
            *[F.percentile_approx(v, shares, SKETCH_ACCURACY).alias(f"g_{v}") for v in self.narrow.columns],
            *[F.sum(f"e{i}").alias(f"e{i}") for i in range(len(extra or {}))],
        ).first()
        self.extra = {name: row[f"e{i}"] for i, name in enumerate(extra or {})}
        self.counts = {name: row[f"n_{v}"] for name, v in zip(self.columns, self.narrow.columns)}
        self.grids = {name: row[f"g_{v}"] for name, v in zip(self.columns, self.narrow.columns)}

    def _brackets(self, name: str, ranks: Sequence[int]) -> list[tuple[float, float]]:
        """Closed ranges of values that hold the ranks, apart from each other, in order."""
        last, grid = max(self.counts[name] - 1, 1), self.grids[name]
        found: list[tuple[float, float]] = []
        for rank in sorted(set(ranks)):
            at = rank * GRID / last
            below, above = floor(at) - 1, ceil(at) + 1
            low, high = (float("-inf") if below < 0 else grid[below]), (float("inf") if above > GRID else grid[above])
            if found and low <= found[-1][1]:
                low, high = found[-1][0], max(high, found[-1][1])
                found.pop()
            found.append((low, high))
        return found

    def values(self, ranks: Mapping[str, Sequence[int]], few_values: int = FEW_CANDIDATES) -> dict[tuple[str, int], float]:
        """Exact value at each 0-based rank of each column."""
        ranks = {name: sorted(set(wanted)) for name, wanted in ranks.items() if wanted}
        as_narrow = dict(zip(self.columns, self.narrow.columns))
        brackets = {name: self._brackets(name, wanted) for name, wanted in ranks.items()}
        # a bracket spans up to four steps of the grid
        near = [name for name in ranks if self.counts[name] * 4 * len(brackets[name]) <= few_values * GRID]
        values = self._counted({name: ranks[name] for name in near}, brackets) if near else {}
        far = {name: missing for name, wanted in ranks.items() if (missing := [r for r in wanted if (name, r) not in values])}
        if far:
            intervals = [_Interval(as_narrow[name], wanted, 0, self.counts[name]) for name, wanted in far.items()]
            found = _select_ranks(self.narrow, intervals, min(few_values, FEW_VALUES))
            values |= {(name, r): found[as_narrow[name], r] for name, wanted in far.items() for r in wanted}
        return values

    def _counted(self, ranks: Mapping[str, Sequence[int]], brackets: Mapping[str, list[tuple[float, float]]]) -> dict[tuple[str, int], float]:
        cells = []
        for name in ranks:
            i, x = self.columns.index(name), F.col(self.narrow.columns[self.columns.index(name)])
            cell, value = F.when(x.isNull(), None), F.when(x.isNull(), None)
            for k, (low, high) in enumerate(brackets[name]):
                cell = cell.when(x < low, 2 * k).when(x <= high, 2 * k + 1)
                value = value.when(x < low, None).when(x <= high, x)
            cells.append(F.struct(F.lit(i).alias("column"), cell.otherwise(2 * len(brackets[name])).alias("cell"), value.alias("value")))
        counted = self.narrow.select(F.inline(F.array(*cells))).where("cell IS NOT NULL").groupBy("column", "cell", "value").agg(F.count(F.lit(1)).alias("rows"))
        so_far = Window.partitionBy("column").orderBy("cell", "value").rowsBetween(Window.unboundedPreceding, 0)
        placed = counted.withColumn("end", F.sum("rows").over(so_far)).where("value IS NOT NULL")
        wanted = F.array(*[F.struct(F.lit(self.columns.index(name)).alias("of"), F.lit(r).cast("bigint").alias("rank")) for name in ranks for r in ranks[name]])
        here = F.filter(wanted, lambda w: (w["of"] == F.col("column")) & (w["rank"] < F.col("end")) & (w["rank"] >= F.col("end") - F.col("rows")))
        found = placed.select("column", "value", F.explode(here).alias("w")).select("column", "value", "w.rank").collect()
        return {(self.columns[r["column"]], r["rank"]): r["value"] for r in found}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    few_values: int = FEW_CANDIDATES,
) -> dict[str, list[float | None]]:
    """Percentiles with linear interpolation; nulls and NaN are left out, no values give None."""
    if not isinstance(columns, Mapping):
        columns = {name: named(name) for name in columns}
    if not columns:
        return {}
    sketch = RankSketch(df, columns)
    places = {name: [p * (n - 1) for p in probabilities] for name, n in sketch.counts.items() if n}
    values = sketch.values({name: [r for at in wanted for r in (floor(at), ceil(at))] for name, wanted in places.items()}, few_values)
    return {
        name: [between(values[name, floor(at)], values[name, ceil(at)], at - floor(at)) for at in places[name]] if name in places else [None] * len(probabilities)
        for name in columns
    }


def distinct_estimate(value: Column) -> Column:
    """Distinct values within a few percent. One small binary buffer per column keeps wide aggregates fast."""
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(hashed)), F.lit(0))


def medians(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float | None]:
    columns = numeric_columns(df) if columns is None else columns
    return {name: values[0] for name, values in exact_quantiles(df, columns, [0.5]).items()}


def between(low: float, high: float, share: float) -> float:
    return low if low == high else low + (high - low) * share


def _select_ranks(narrow: DataFrame, intervals: list[_Interval], few_values: int) -> dict[tuple[str, int], float]:
    values: dict[tuple[str, int], float] = {}
    while wide := [i for i in intervals if i.rows > few_values]:
        intervals = [i for i in intervals if i.rows <= few_values]
        for interval, cuts in zip(wide, _count_around(narrow, wide, _pivots(narrow, wide))):
            intervals += _descend(interval, cuts, values)
    if intervals:
        values.update(_count_out(narrow, intervals))
    return values


def _pivots(narrow: DataFrame, intervals: list[_Interval]) -> list[list[float]]:
    """Values a little below and a little above each wanted rank."""
    slack = 2 / SKETCH_ACCURACY
    sketches = []
    for k, interval in enumerate(intervals):
        at = [(rank - interval.below + 0.5) / interval.rows for rank in interval.ranks]
        shares = sorted({min(1.0, max(0.0, round(a + s, 6))) for a in at for s in (-slack, slack)})
        x = F.when(interval.holds(), F.col(interval.column))
        sketches.append(F.percentile_approx(x, shares, SKETCH_ACCURACY).alias(f"k{k}"))
    return [sorted(set(pivots)) for pivots in narrow.agg(*sketches).first()]


def _count_around(narrow: DataFrame, intervals: list[_Interval], pivots: list[list[float]]):
    """For each interval, its pivots with the rows below and at them."""
    counts = []
    for interval, cuts in zip(intervals, pivots):
        x, inside = F.col(interval.column), interval.holds()
        for cut in cuts:
            counts += [F.count_if(inside & (x < cut)), F.count_if(inside & (x == cut))]
    found = iter(narrow.agg(*[c.alias(f"c{k}") for k, c in enumerate(counts)]).first())
    return [[(cut, next(found), next(found)) for cut in cuts] for cuts in pivots]


def _descend(interval: _Interval, cuts, values: dict) -> list[_Interval]:
    """Ranks that sit on a pivot are solved; the gaps that hold the others are searched next."""
    gaps: dict[tuple, _Interval] = {}
    for rank in interval.ranks:
        offset = rank - interval.below
        low, passed, high, limit = interval.low, 0, interval.high, interval.rows
        for cut, less, equal in cuts:
            if less <= offset < less + equal:
                values[interval.column, rank] = cut
                break
            if offset < less:
                high, limit = cut, less
                break
            low, passed = cut, less + equal
        else:
            cut = None
        if (interval.column, rank) not in values:
            gap = _Interval(interval.column, [], interval.below + passed, limit - passed, low, high)
            gaps.setdefault((low, high), gap).ranks.append(rank)
    return list(gaps.values())


def _count_out(narrow: DataFrame, intervals: list[_Interval]) -> dict[tuple[str, int], float]:
    """Ranks inside small intervals, from their value counts; each interval is a group of its own."""
    candidates = [
        F.when(i.holds(), F.struct(F.lit(k).alias("interval"), F.col(i.column).alias("value")))
        for k, i in enumerate(intervals)
    ]
    counted = (
        narrow.filter(reduce(or_, [i.holds() for i in intervals]))
        .select(F.explode(F.array(*candidates)).alias("c"))
        .filter("c is not null")
        .groupBy("c.interval", "c.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    so_far = Window.partitionBy("interval").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("end", F.sum("rows").over(so_far))
    wanted = [
        F.when(
            (F.col("interval") == k) & F.lit(rank - i.below).between(F.col("end") - F.col("rows"), F.col("end") - 1),
            F.lit(rank),
        )
        for k, i in enumerate(intervals)
        for rank in i.ranks
    ]
    found = placed.select("interval", "value", F.explode(F.array(*wanted)).alias("rank")).filter("rank is not null")
    return {(intervals[row["interval"]].column, row["rank"]): row["value"] for row in found.collect()}
