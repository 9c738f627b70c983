"""Balanced classifiers on scaled features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.linear import helper_columns, scaling_stage
from rowmill.operators.scale import fit_standard
from rowmill.storage import new_path

FOREST_ROWS = 1_000_000  # labelled rows a forest is grown from; the model on the driver grows with them
MODEL_TYPES = ("logistic", "random_forest")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(class, rows, weight)`` with weight n / (classes · class rows)."""
    counts = df.groupBy(named(label).alias("class")).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return counts.withColumn("weight", F.try_divide(F.lit(float(totals["n"] or 0)), totals["k"] * F.col("rows")))


def with_class_weights(df: DataFrame, label: str, weights: dict, column: str = "weight") -> DataFrame:
    """Weight per row. Weights go by class, so they do not depend on the order of the classes."""
    chain = F
    for name, weight in weights.items():
        chain = chain.when(named(label) == name, F.lit(float(weight)))
    return df.withColumn(column, chain.otherwise(0.0))


def encode_labels(label: Column, classes: Sequence[str]) -> Column:
    """Class → its position in sorted order."""
    chain = F
    for i, name in enumerate(sorted(classes)):
        chain = chain.when(label == name, F.lit(i))
    return chain


def decode_labels(index: Column, classes: Sequence[str]) -> Column:
    return F.try_element_at(F.array(*map(F.lit, sorted(classes))), index.cast("int") + 1)


@dataclass(frozen=True)
class ClassifierFit:
    model: PipelineModel
    model_type: str
    features: list[str]
    classes: list[str]
    weights: dict[str, float]


def without_summaries(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """The pipeline written and read back, which leaves the training summaries behind.

    The summary of a model with two classes holds the session. Scoring sends the model to the tasks, which fails in
    every session that has observed a table.
    """
    path = new_path(spark, "classifier")
    model.write().save(path)
    return PipelineModel.load(path)


def train_classifier(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    model_type: str = "logistic",
    trees: int = 100,
    max_depth: int = 30,
    seed: int = 42,
    forest_rows: int = FOREST_ROWS,
) -> ClassifierFit:
    """Scaler, balanced classifier and label decoding as one pipeline that saves and loads as a whole.

    Logistic models are one against the rest with unit inverse penalty: the regularisation per weighted
    row is 1 / total weight, and balanced weights add up to the row count. Forests are grown from about
    ``forest_rows`` rows at most, drawn by hash.
    """
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type: {model_type}")
    counted = class_weights(df, label).collect()
    weights = {row["class"]: row["weight"] for row in counted}
    if not weights:
        raise ValueError("no training rows")
    classes = sorted(weights)
    labelled = sum(row["rows"] for row in counted)
    if model_type == "random_forest" and labelled > forest_rows:
        share = int(forest_rows / labelled * (1 << 31))
        df = df.filter(F.pmod(F.xxhash64(*map(named, df.columns)), F.lit(1 << 31)) < share)
    shared = {"featuresCol": "_features", "labelCol": "_label", "weightCol": "_weight"}
    if model_type == "logistic":
        rows = sum(row["rows"] for row in counted)
        binary = LogisticRegression(**shared, maxIter=1000, regParam=1.0 / rows, standardization=False, tol=1e-6)
        # the few binary fits are independent, so their small jobs may interleave
        estimator = OneVsRest(classifier=binary, **shared, predictionCol="_class", parallelism=min(len(classes), 8))
    else:
        estimator = RandomForestClassifier(
            **shared,
            predictionCol="_class",
            numTrees=trees,
            maxDepth=max_depth,
            featureSubsetStrategy="sqrt",
            seed=seed,
            maxMemoryInMB=1024,  # more tree nodes per pass over the rows
            cacheNodeIds=True,  # deep trees need not be walked again for every level
        )
    stages = [
        StringIndexerModel.from_labels(classes, inputCol=label, outputCol="_label", handleInvalid="keep"),
        scaling_stage(features, fit_standard(df, features)),
        VectorAssembler(inputCols=[f"_z{i}" for i in range(len(features))], outputCol="_features"),
        estimator,
        IndexToString(inputCol="_class", outputCol="predicted", labels=classes),
    ]
    model = Pipeline(stages=stages).fit(with_class_weights(df, label, weights, "_weight"))
    if model_type == "logistic" or model.stages[3].numClasses == 2:
        model = without_summaries(df.sparkSession, model)
    return ClassifierFit(model, model_type, list(features), classes, weights)


def classify(df: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Add ``predicted``."""
    extra = [*helper_columns(features), "_label", "_class", "rawPrediction", "probability"]
    return model.transform(df).drop(*extra)
