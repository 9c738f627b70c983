"""From raw records to a model-ready table: the ``improved`` and ``simple`` presets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.text import Rules, named
from rowmill.operators.categorical import Encoder, far_beyond, fit_encoder
from rowmill.operators.columns import Stage, numeric_columns, run_stages, split_target, text_columns
from rowmill.operators.correlation import fit_collinear
from rowmill.operators.dedupe import drop_duplicate_rows, merge_duplicate_features, reduction_report
from rowmill.operators.impute import fill_missing, fit_medians, fit_modes, prepare_features
from rowmill.operators.outliers import count_outliers, fit_bounds, limit_to_bounds, remove_outlier_rows
from rowmill.operators.scale import Scaling, fit_normalizer, normalize
from rowmill.operators.summary import value_summary
from rowmill.operators.target import AmountTreatment, fit_amount_treatment, prepare_target
from rowmill.plans import resume_values as v
from rowmill.plans.resume_features import advanced_features, basic_features, clean_table, with_base_currency
from rowmill.storage import materialize

GROUP_SIZE = "rows in group"


@dataclass(frozen=True)
class PresetOptions:
    """What a preset does. The ``published`` variants repeat the published choices listed in ``_as_published``; the
    plain ones keep amounts out of the features, do not scale the target and take its log only once."""

    salary_threshold: float | None
    advanced: bool = True
    encode: bool = True
    collinear_threshold: float | None = v.CORRELATION_THRESHOLD
    outlier_detector: str | None = "iqr"
    outlier_action: str = "clip"
    outlier_threshold: float = v.OUTLIER_THRESHOLD
    normalize: bool = True
    currency_rules: Rules = field(default_factory=lambda: v.CURRENCY_RULES)
    rates: Mapping[str, float] = field(default_factory=lambda: v.RATES)
    leaks: tuple[str, ...] = (v.SALARY, v.SALARY_BASE)
    scale_target: bool = False
    second_log: bool = False
    max_distinct: int = v.MAX_DISTINCT
    max_one_hot: int = v.MAX_ONE_HOT
    extra_stages: tuple[Stage, ...] = ()


def _as_published(options: PresetOptions) -> PresetOptions:
    # the published outlier step names an action but no detector, and so finds nothing
    return replace(options, outlier_detector=None, leaks=(), scale_target=True, second_log=True)


def improved(published: bool = False) -> PresetOptions:
    options = PresetOptions(salary_threshold=v.IMPROVED_SALARY_THRESHOLD)
    return _as_published(options) if published else options


def simple(published: bool = False) -> PresetOptions:
    options = PresetOptions(
        salary_threshold=v.SIMPLE_SALARY_THRESHOLD,
        advanced=False,
        encode=False,
        collinear_threshold=None,
        outlier_detector=None,
        normalize=False,
    )
    return _as_published(options) if published else options


@dataclass(frozen=True)
class FittedPreset:
    """Everything learned from the fitting table; ``apply`` prepares other records the same way."""

    options: PresetOptions
    row_id: str
    target: str
    amounts: AmountTreatment
    fills: dict[str, object]
    encoder: Encoder
    collinear: list[str]
    bounds: dict[str, tuple[float, float]]
    scaled: list[str]
    scalings: Sequence[Scaling]

    def encode(self, df: DataFrame) -> DataFrame:
        return self.encoder.apply(fill_missing(df, self.fills))

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop collinear columns, treat outliers and scale."""
        kept = df.drop(*self.collinear)
        limit = remove_outlier_rows if self.options.outlier_action == "remove" else limit_to_bounds
        return normalize(limit(kept, self.bounds), self.scaled, self.scalings)

    def apply(self, df: DataFrame) -> DataFrame:
        features = extract(df, self.options, self.row_id)
        return self.finish(self.encode(self.amounts.apply(features).drop(*self.options.leaks)))


@dataclass(frozen=True)
class Prepared:
    """A model-ready table: ``row_id``, the features, and the target."""

    table: DataFrame
    features: list[str]
    target: str
    row_id: str
    fitted: FittedPreset | None = None
    reports: Mapping[str, Callable[[], DataFrame]] = field(default_factory=dict)


def extract(df: DataFrame, options: PresetOptions, row_id: str) -> DataFrame:
    """Row-by-row part of a preset: clean text, then typed features."""
    stages: list[Stage] = [
        clean_table,
        lambda t: with_base_currency(t, options.currency_rules, options.rates),
        basic_features,
    ]
    if options.advanced:
        stages.append(advanced_features)
    return run_stages(df, [*stages, *options.extra_stages])


def prepare(df: DataFrame, options: PresetOptions, row_id: str, target: str = v.SALARY_NUMBER) -> Prepared:
    """Fit a preset on ``df`` and apply it.

    Tables are written to the shared scratch folder after the steps that shuffle, so the many small
    fits that follow read single columns from Parquet instead of repeating the work before them.
    """
    records = drop_duplicate_rows(df, row_id)
    extracted = materialize(extract(records, options, row_id), "extracted")
    split_target(extracted, target)
    amounts = fit_amount_treatment(extracted, target, options.salary_threshold)
    treated = amounts.apply(extracted).drop(*options.leaks)
    grouped = materialize(merge_duplicate_features(treated, target, row_id=row_id, size_column=GROUP_SIZE), "merged")
    merged = grouped.drop(GROUP_SIZE)

    medians = fit_medians(merged, exclude=[row_id])
    # columns the encoder is sure to drop need no mode, which would shuffle all their values
    hopeless = far_beyond(merged, text_columns(merged), options.max_distinct) if options.encode else []
    fills = {**medians, **fit_modes(merged, v.NOT_STATED, exclude=hopeless)}
    filled = fill_missing(merged, fills)
    encoder, collinear, bounds, scaled, scalings = Encoder(target=target), [], {}, [], []
    if options.encode:
        encoder = fit_encoder(filled, target, [row_id], options.max_distinct, options.max_one_hot)
    encoded = materialize(encoder.apply(filled), "encoded") if options.encode else filled
    if options.collinear_threshold is not None:
        collinear = fit_collinear(encoded, options.collinear_threshold, exclude=[row_id, target])
    kept = encoded.drop(*collinear)
    fixed = [row_id] if options.scale_target else [row_id, target]
    if options.outlier_detector is not None:
        columns = numeric_columns(kept, fixed)
        bounds = fit_bounds(kept, options.outlier_detector, options.outlier_threshold, columns)
    limit = remove_outlier_rows if options.outlier_action == "remove" else limit_to_bounds
    limited = limit(kept, bounds)
    if options.normalize:
        scaled, scalings = fit_normalizer(limited, robust=True, standard=True, exclude=fixed)
    fitted = FittedPreset(options, row_id, target, amounts, fills, encoder, collinear, bounds, scaled, scalings)
    table = fitted.finish(encoded)

    features, _ = split_target(table, target, ignore=[row_id])
    if options.second_log:
        table = prepare_target(table, target)
    numbers = prepare_features(table, features)
    ordered = numbers.select(named(row_id), *[named(c).cast("double").alias(c) for c in [*features, target]])
    # computed only when asked for, from the tables written above
    reports = {
        "amounts": lambda: amount_summaries(extracted, treated, target),
        "reduction": lambda: reduction_report(grouped, GROUP_SIZE),
        "outliers": lambda: count_outliers(kept, bounds),
    }
    return Prepared(ordered, features, target, row_id, fitted, reports if bounds else {k: r for k, r in reports.items() if k != "outliers"})


def amount_summaries(before: DataFrame, after: DataFrame, target: str) -> DataFrame:
    """Positive amounts as they came, and the target that became of all of them: count, range, mean and median."""
    rows = [value_summary(table, target, positive).withColumn("stage", F.lit(stage)) for stage, table, positive in (("before", before, True), ("after", after, False))]
    return rows[0].unionByName(rows[1])
