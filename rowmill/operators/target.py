"""Preparing the regression target."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor, log1p

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import to_number
from rowmill.functions.text import named
from rowmill.operators.columns import assign
from rowmill.operators.quantiles import RankSketch, between


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """One row: smallest positive value (1.0 if none), rows at or below zero, and their share."""
    y = to_number(named(target))
    low = F.count_if(y <= 0)
    return df.agg(
        F.coalesce(F.min(F.when(y > 0, y)), F.lit(1.0)).alias("min_positive"),
        low.alias("non_positive"),
        F.try_divide(low, F.count(F.lit(1))).alias("non_positive_share"),
    )


def prepare_target(df: DataFrame, target: str) -> DataFrame:
    """Target as log1p of a positive number: values at or below zero take the smallest positive one."""
    smallest = target_profile(df, target).first()["min_positive"]
    y = to_number(named(target))
    raised = assign(df.withColumn(target, y), y <= 0, target, smallest)
    return raised.withColumn(target, F.log1p(named(target)))


@dataclass(frozen=True)
class AmountTreatment:
    """Fitted treatment of an amount column; ``None`` fields mean the step does not apply."""

    column: str
    threshold: float | None
    cap: float | None = None
    fill: float | None = None
    active: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.active:
            return df
        amount = named(self.column)
        capped = amount if self.cap is None else F.when(amount > self.threshold, F.lit(self.cap)).otherwise(amount)
        return df.withColumn(self.column, F.when(amount > 0, F.log1p(capped)).otherwise(F.lit(self.fill)))


def fit_amount_treatment(df: DataFrame, column: str, threshold: float | None) -> AmountTreatment:
    """Amounts over ``threshold`` become the 95th percentile of the others, valid ones go to log scale,
    and the rest take the median log. Without a threshold or a valid amount nothing is done."""
    amount = named(column)
    if not threshold:
        return AmountTreatment(column, None)
    # Both are fitted whenever there is a valid amount: other rows may need what these rows do not.
    values = {"usual": F.when((amount > 0) & (amount <= threshold), amount), "over": F.when(amount > threshold, amount)}
    sketch = RankSketch(df, values)
    usual, over = sketch.counts["usual"], sketch.counts["over"]
    if not usual + over:
        return AmountTreatment(column, threshold)
    middle = (usual + over - 1) / 2
    if not usual:  # no usual amount at all leaves nothing to cap to
        found = sketch.values({"over": [floor(middle), ceil(middle)]})
        return AmountTreatment(column, threshold, None, between(log1p(found["over", floor(middle)]), log1p(found["over", ceil(middle)]), 0.5), True)
    # The capped amounts in order are the usual ones with a cap for every other one put in where it belongs, so
    # their ranks are ranks of the usual ones: both quantiles come from the same two passes.
    at = 0.95 * (usual - 1)
    put_in = floor(at) + 1
    of_middle = {r: r if r < put_in else r - over if r >= put_in + over else None for r in (floor(middle), ceil(middle))}
    found = sketch.values({"usual": [floor(at), ceil(at), *[r for r in of_middle.values() if r is not None]]})
    cap = between(found["usual", floor(at)], found["usual", ceil(at)], at - floor(at))
    capped = {r: cap if place is None else found["usual", place] for r, place in of_middle.items()}
    low, high = capped[floor(middle)], capped[ceil(middle)]
    return AmountTreatment(column, threshold, cap, between(log1p(low), log1p(high), 0.5), True)
