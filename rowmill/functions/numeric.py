"""Number functions: coercion, bins, clips and error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# A whole text that is a number: blanks around it, sign, digits with point and exponent, or a name of a special value.
# Spark's own cast would also take suffixes, as in 10D.
NUMBER_TEXT = r"^[\s\x00-\x1F]*[-+]?([0-9]+\.?[0-9]*([eE][-+]?[0-9]+)?|\.[0-9]+([eE][-+]?[0-9]+)?|(?i:inf|infinity|nan))[\s\x00-\x1F]*$"


def to_number(value: Column) -> Column:
    """Double, with unreadable text and NaN turned into null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def text_to_number(text: Column) -> Column:
    """:func:`to_number` for text: null unless the whole text is a number."""
    return to_number(F.when(text.rlike(NUMBER_TEXT), text))


def step(value: Column, cuts: Sequence[float], labels: Sequence[str], closed: str = "left") -> Column:
    """Label of the step that holds ``value``; one label more than cuts.

    ``closed='left'`` puts a value equal to a cut in the step above it, ``'right'`` in the one below.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one label more than cuts")
    chain = F
    for cut, label in zip(cuts, labels):
        chain = chain.when(value < cut if closed == "left" else value <= cut, F.lit(label))
    return chain.when(value.isNotNull(), F.lit(labels[-1]))


def right_closed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (low, high] that holds ``value``; null outside all bins."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need exactly one label per bin")
    chain = F.when(value <= edges[0], F.lit(None))
    for edge, label in zip(edges[1:], labels):
        chain = chain.when(value <= edge, F.lit(label))
    return chain.cast("string")


def clip(value: Column, low=None, high=None) -> Column:
    """Limit ``value`` to [low, high]; null and NaN values stay, a missing bound does not limit."""
    result = value
    if low is not None:
        result = F.when(result < low, F.lit(low)).otherwise(result)
    if high is not None:
        result = F.when((result > high) & ~F.isnan(result), F.lit(high)).otherwise(result)
    return result


def nonzero(value: Column, epsilon: float = 1e-10) -> Column:
    """``value`` with exact zeros replaced by ``epsilon``."""
    return F.when(value == 0, F.lit(epsilon)).otherwise(value)


def signed_percent_error(actual: Column, predicted: Column, floor: float = 1e-10) -> Column:
    return (predicted - actual) / F.greatest(actual, F.lit(floor)) * 100


def quality_band(r2: Column) -> Column:
    """Verdict on a model's R²."""
    return step(r2, [0.2, 0.4, 0.6], ["very poor", "moderate", "good", "excellent"])
