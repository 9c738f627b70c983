"""Class labels from keyword and number rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import step
from rowmill.functions.text import Rules, contains_any, flag, last_rule, named
from rowmill.operators.columns import first_present

UNKNOWN = "unknown"


@dataclass(frozen=True)
class LevelRules:
    """How to label a record: keyword lists (a later list overrides), years of experience for records no
    keyword decides, and the keywords that mark a record as relevant."""

    title_aliases: Sequence[str]
    keywords: Rules
    year_cuts: Sequence[float]
    year_levels: Sequence[str]
    scope_keywords: Sequence[str]
    fallback: str
    min_rows: int = 100


def with_levels(df: DataFrame, rules: LevelRules, years: Column | None = None) -> DataFrame:
    """Add ``level`` and ``in_scope``. Without any title column every row gets the fallback level."""
    title_column = first_present(df, rules.title_aliases)
    if title_column is None:
        return df.withColumns({"level": F.lit(rules.fallback), "in_scope": F.lit(True)})
    title = F.lower(named(title_column))
    by_years = F.lit(UNKNOWN) if years is None else step(years, rules.year_cuts, rules.year_levels)
    return df.withColumns(
        {
            "level": F.coalesce(last_rule(title, rules.keywords), by_years),
            "in_scope": contains_any(title, rules.scope_keywords),
        }
    )


def keyword_hits(df: DataFrame, rules: LevelRules) -> DataFrame:
    """``(rule, rows)``: rows each keyword list matches on its own, and rows in scope."""
    title_column = first_present(df, rules.title_aliases)
    title = F.lower(named(title_column)) if title_column else F.lit(None).cast("string")
    lists = [*rules.keywords, ("in scope", rules.scope_keywords)]
    counted = df.agg(*[F.coalesce(F.sum(flag(contains_any(title, words))), F.lit(0)).alias(name) for name, words in lists])
    entries = [F.struct(F.lit(name).alias("rule"), named(name).alias("rows")) for name, _ in lists]
    return counted.select(F.inline(F.array(*entries)))


def keep_labelled(df: DataFrame, rules: LevelRules) -> DataFrame:
    """Rows in scope with a known level; if those are fewer than ``min_rows``, scope is ignored.

    Looking for that many rows stops as soon as they are found.
    """
    known = df.filter(F.col("level") != UNKNOWN)
    scoped = known.filter("in_scope")
    return scoped if len(scoped.select(F.lit(1)).take(rules.min_rows)) >= rules.min_rows else known
