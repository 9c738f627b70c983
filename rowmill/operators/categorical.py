"""Turning text columns into numbers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.columns import replace_columns, text_columns
from rowmill.operators.impute import value_counts
from rowmill.operators.joins import map_values
from rowmill.operators.quantiles import distinct_estimate
from rowmill.storage import materialize


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, distinct_values)`` per column, nulls not counted, all columns in one shuffle."""
    names = F.array(*map(F.lit, columns))
    per_column = value_counts(df.select(*map(named, columns)), columns).groupBy("position")
    return per_column.agg(F.count("value").alias("distinct_values")).select(
        F.element_at(names, F.col("position") + 1).alias("feature"), "distinct_values"
    )


def far_beyond(df: DataFrame, columns: Sequence[str], max_distinct: int) -> list[str]:
    """Columns with surely more than ``max_distinct`` values, told by a sketch of twice the limit."""
    if not columns:
        return []
    sizes = df.agg(*[distinct_estimate(named(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return [c for c, size in zip(columns, sizes) if size > 2 * max_distinct]


@dataclass(frozen=True)
class CategoryProfile:
    """Per-value statistics of the text columns that are not out of hand.

    ``table`` holds ``(position, value, rows, first_seen, target_mean)``; its size is bounded by the
    number of columns times twice the distinct-value limit.
    """

    columns: list[str]
    distinct: dict[str, int]
    bytes: dict[str, int]
    nulls: dict[str, bool]
    too_many: list[str]
    table: DataFrame | None
    global_mean: float | None

    def lookup(self, name: str) -> DataFrame:
        own = self.table.filter((F.col("position") == self.columns.index(name)) & F.col("value").isNotNull())
        return own.select(F.col("value").alias("key"), F.col("target_mean").alias("value"))


def profile_categories(
    df: DataFrame,
    columns: Sequence[str],
    target: str | None = None,
    order_by: Sequence[str] = (),
    max_distinct: int = 5000,
) -> CategoryProfile:
    """Everything the encoders need, in two passes over the table.

    A sketch first sets aside columns far beyond the limit, so that nobody shuffles their values; the
    exact counts of the rest decide. ``order_by`` defines which value was seen first.
    """
    measures = [distinct_estimate(named(c)).alias(f"d{i}") for i, c in enumerate(columns)]
    y = named(target).cast("double") if target else F.lit(None).cast("double")
    sizes = df.agg(F.avg(y).alias("global_mean"), *measures).first()
    near = [c for i, c in enumerate(columns) if sizes[f"d{i}"] <= 2 * max_distinct]
    far = [c for c in columns if c not in near]
    if not near:
        return CategoryProfile([], {}, {}, {}, far, None, sizes["global_mean"])
    seen = F.struct(*map(named, order_by)) if len(order_by) > 1 else named(order_by[0]) if order_by else F.lit(0)
    cells = F.array(*[F.struct(F.lit(i).alias("position"), named(c).alias("value")) for i, c in enumerate(near)])
    table = materialize(
        df.select(F.inline(cells), seen.alias("seen"), y.alias("y"))
        .groupBy("position", "value")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("seen").alias("first_seen"),
            F.avg("y").alias("target_mean"),
        ),
        "categories",
    )
    counted = table.groupBy("position").agg(
        F.count("value").alias("distinct"), F.count_if(F.col("value").isNull()).alias("nulls"),
        F.sum(F.octet_length("value") + 24).alias("bytes"),
    )
    found = {near[row["position"]]: row for row in counted.collect()}
    distinct = {c: found[c]["distinct"] if c in found else 0 for c in near}
    sizes_of = {c: (found[c]["bytes"] or 0) if c in found else 0 for c in near}
    nulls = {c: bool(found[c]["nulls"]) if c in found else False for c in near}
    too_many = [c for c in columns if c in far or distinct[c] > max_distinct]
    return CategoryProfile(near, distinct, sizes_of, nulls, too_many, table, sizes["global_mean"])


@dataclass(frozen=True)
class Encoder:
    """Fitted encoding of a table's text columns; ``apply`` is a projection plus small broadcasts."""

    dropped: list[str] = field(default_factory=list)
    binary: dict[str, tuple[str, str]] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    one_hot_names: dict[str, list[str]] = field(default_factory=dict)
    by_target: list[str] = field(default_factory=list)
    profile: CategoryProfile | None = None
    target: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        kept = df.drop(*self.dropped)
        kept = apply_binary(kept, self.binary)
        kept = apply_one_hot(kept, self.one_hot, self.one_hot_names)
        for name in self.by_target:
            kept = apply_target_means(kept, name, self.profile)
        if self.target in kept.columns:
            kept = kept.select(*[named(c) for c in kept.columns if c != self.target], named(self.target))
        return kept


def apply_binary(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """First-seen value → 0.0, the other → 1.0, anything else → null."""
    return replace_columns(
        df,
        {
            name: F.when(named(name) == zero, F.lit(0.0)).when(named(name) == one, F.lit(1.0))
            for name, (zero, one) in mapping.items()
        },
    )


def one_hot_names(columns: Iterable[str], categories: dict[str, list[str]]) -> dict[str, list[str]]:
    """Name of the new column for each category but the first: ``<column>_<value>``.

    A name that another column has, in whatever case, gets the first free number behind it.
    """
    taken = {c.lower() for c in columns if c not in categories}
    names: dict[str, list[str]] = {}
    for column, values in categories.items():
        names[column] = []
        for value in values[1:]:
            name, n = f"{column}_{value}", 2
            while name.lower() in taken:
                name, n = f"{column}_{value}_{n}", n + 1
            taken.add(name.lower())
            names[column].append(name)
    return names


def apply_one_hot(df: DataFrame, categories: dict[str, list[str]], names: dict[str, list[str]] | None = None) -> DataFrame:
    """A boolean column per category but the first, after the other columns; names as fitted, or as they fit ``df``."""
    names = names or one_hot_names(df.columns, categories)
    new = {
        name: F.coalesce(named(column) == value, F.lit(False))
        for column, values in categories.items()
        for name, value in zip(names[column], values[1:])
    }
    rest = [named(c) for c in df.columns if c not in categories]
    return df.select(*rest, *[flag.alias(name) for name, flag in new.items()])


def apply_target_means(df: DataFrame, name: str, profile: CategoryProfile) -> DataFrame:
    """Category → mean target; null and unknown categories → global mean."""
    default = F.lit(profile.global_mean).cast("double")
    return map_values(df, name, profile.lookup(name), default, profile.bytes[name])


def fit_encoder(
    df: DataFrame,
    target: str | None = None,
    order_by: Sequence[str] = (),
    max_distinct: int = 5000,
    max_one_hot: int = 20,
    exclude: Iterable[str] = (),
) -> Encoder:
    """Choose an encoding per text column by its distinct values.

    More than ``max_distinct``: dropped. Two, and no nulls: binary. Three to ``max_one_hot``: one-hot,
    categories in sorted order. All others: mean target, if there is a target.
    """
    columns = text_columns(df, {*exclude, target} if target else exclude)
    if not columns:
        return Encoder(target=target)
    profile = profile_categories(df, columns, target, order_by, max_distinct)
    usable = [c for c in profile.columns if c not in profile.too_many]
    two = [c for c in usable if profile.distinct[c] == 2 and not profile.nulls[c]]
    several = [c for c in usable if 2 < profile.distinct[c] <= max_one_hot]
    binary, one_hot = {}, {}
    if two or several:
        positions = [profile.columns.index(c) for c in two + several]
        small = profile.table.filter(F.col("position").isin(positions) & F.col("value").isNotNull())
        rows = small.select("position", "value", "first_seen").collect()
        for name in two:
            own = [r for r in rows if profile.columns[r["position"]] == name]
            binary[name] = tuple(r["value"] for r in sorted(own, key=lambda r: (r["first_seen"], r["value"])))
        for name in several:
            one_hot[name] = sorted(r["value"] for r in rows if profile.columns[r["position"]] == name)
    by_target = [c for c in usable if c not in binary and c not in one_hot] if target else []
    names = one_hot_names([c for c in df.columns if c not in profile.too_many], one_hot)
    return Encoder(profile.too_many, binary, one_hot, names, by_target, profile, target)
