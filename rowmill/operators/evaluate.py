"""Quality of predictions, each report from a single aggregate over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import clip, nonzero, signed_percent_error
from rowmill.functions.text import named

FLOOR = 1e-10


def _error_measures(y: Column, p: Column, suffix: str) -> list[Column]:
    e = y - p
    r2 = F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))
    return [
        F.avg(F.abs(e)).alias(f"mae_{suffix}"),
        F.avg(e * e).alias(f"mse_{suffix}"),
        F.sqrt(F.avg(e * e)).alias(f"rmse_{suffix}"),
        r2.alias(f"r2_{suffix}"),
    ]


def back_transform(log_value: Column) -> Column:
    """From log1p scale to amounts, exact zeros made a tiny positive number."""
    return nonzero(F.expm1(log_value), FLOOR)


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of errors on the log scale and on the amount scale."""
    y, p = named(actual), named(predicted)
    amount, guess = back_transform(y), back_transform(p)
    relative = F.abs((amount - guess) / F.greatest(amount, F.lit(FLOOR)))

    def share_within(limit: float) -> Column:
        return F.avg(F.when(relative < limit, 100.0).otherwise(0.0))

    return df.agg(
        *_error_measures(y, p, "log"),
        *_error_measures(amount, guess, "amount"),
        (F.avg(relative) * 100).alias("mape"),
        share_within(0.2).alias("within_20_pct"),
        share_within(0.3).alias("within_30_pct"),
        F.count_if(F.expm1(p) == 0).alias("zero_predictions"),
        F.count_if(F.expm1(y) == 0).alias("zero_actuals"),
    )


def to_amounts(df: DataFrame, prediction: str, lowest: float = 10_000.0) -> DataFrame:
    """Predicted log values as amounts of at least ``lowest``."""
    return df.withColumn(prediction, clip(F.expm1(named(prediction)), low=lowest))


def sample_predictions(df: DataFrame, actual: str, predicted: str, row_id: str, rows: int = 5) -> DataFrame:
    """The first rows with actual and predicted amount and the signed error in percent."""
    amount, guess = back_transform(named(actual)), back_transform(named(predicted))
    return (
        df.orderBy(named(row_id))
        .limit(rows)
        .select(
            named(row_id),
            amount.alias("actual"),
            guess.alias("predicted"),
            signed_percent_error(amount, guess, FLOOR).alias("error_pct"),
        )
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``(class, rows, percent)``."""
    counts = df.groupBy(named(label).alias("class")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("_total"))
    shares = counts.join(F.broadcast(total))  # one row
    return shares.select("class", "rows", (F.col("rows") / F.col("_total") * 100).alias("percent"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    pair = named(label).alias("actual"), named(predicted).alias("predicted")
    return df.groupBy(*pair).agg(F.count(F.lit(1)).alias("rows"))


def class_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """``(class, precision, recall, f1, support)`` for each class seen; an undefined ratio is 0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    as_actual = F.struct(
        F.col("actual").alias("class"), F.col("rows").alias("support"), hit.alias("hits"), F.lit(0).alias("claimed")
    )
    as_claim = F.struct(
        F.col("predicted").alias("class"), F.lit(0).alias("support"), F.lit(0).alias("hits"), F.col("rows").alias("claimed")
    )
    totals = (
        confusion(df, label, predicted)
        .select(F.inline(F.array(as_actual, as_claim)))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("claimed").alias("claimed"))
    )

    def ratio(part: str, *whole: Column) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), *whole), F.lit(0.0))

    return totals.select(
        "class",
        ratio("hits", F.col("claimed")).alias("precision"),
        ratio("hits", F.col("support")).alias("recall"),
        # harmonic mean of the two, written on the counts
        F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("claimed") + F.col("support")), F.lit(0.0)).alias("f1"),
        "support",
    )


def averaged_metrics(per_class: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a per-class table, one row each, with the accuracy."""
    names = ["precision", "recall", "f1"]
    weight = F.col("support")
    totals = per_class.agg(
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[F.try_divide(F.sum(F.col(n) * weight), F.sum(weight)).alias(f"weighted_{n}") for n in names],
        F.sum("support").alias("support"),
    )
    rows = [
        F.struct(
            F.lit(kind).alias("average"),
            *[F.col(f"{kind}_{n}").alias(n) for n in names],
            # recall weighted by support is the share of rows predicted right
            F.col("weighted_recall").alias("accuracy"),
            F.col("support").alias("support"),
        )
        for kind in ("macro", "weighted")
    ]
    return totals.select(F.inline(F.array(*rows)))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    right = F.when(named(label) == named(predicted), 1.0).otherwise(0.0)
    return df.agg(F.avg(right).alias("accuracy"))
