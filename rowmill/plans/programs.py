"""The three jobs end to end, from files to files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.classify import MODEL_TYPES
from rowmill.operators.columns import split_target
from rowmill.operators.correlation import near_duplicate_pairs, pair_correlations
from rowmill.operators.evaluate import averaged_metrics, class_distribution
from rowmill.operators.summary import quality_report
from rowmill.plans import resume_values as v
from rowmill.plans.prepare import Prepared, PresetOptions, prepare
from rowmill.plans.salary import SalaryModel, train_salary_model
from rowmill.plans.seniority import SeniorityResult, classification_set, compare_models, train_seniority_models
from rowmill.sources.csv import read_csv
from rowmill.sources.matrix import read_matrix, verify_written, write_matrix
from rowmill.sources.metadata import write_feature_metadata, write_feature_names
from rowmill.sources.models import save_classifier, save_linear, write_class_report
from rowmill.storage import materialize

ROW_ID = "row_id"


def read_records(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """CSV records with a ``row_id``: the unnamed index column if it tells all rows apart, else a generated id.

    Several files usually count from 0 each, so their index does not. A generated id depends on how the files are
    split: the table is written once and re-read, and feature preparation and labelling must share it.
    """
    raw = read_csv(spark, path, multi_line=multi_line)
    if "_c0" in raw.columns:
        index = raw.select(named("_c0").try_cast("bigint").alias("id"))
        if index.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").isEmpty():
            return raw.withColumnRenamed("_c0", ROW_ID).withColumn(ROW_ID, named(ROW_ID).cast("bigint"))
        raw = raw.drop("_c0")
    return materialize(raw.withColumn(ROW_ID, F.monotonically_increasing_id()), "records")


def prepare_records(records: DataFrame, options: PresetOptions, out: str) -> tuple[Prepared, DataFrame]:
    """Write matrix, names, metadata and quality report; the result's second part is the write check."""
    spark = records.sparkSession
    prepared = prepare(records, options, ROW_ID)
    sent = write_matrix(prepared.table, f"{out}/matrix", prepared.features, prepared.target, ROW_ID)
    written = read_matrix(spark, f"{out}/matrix")
    write_feature_metadata(written.drop(ROW_ID), f"{out}/metadata")
    write_feature_names(spark, prepared.features, f"{out}/names")
    report = quality_report(written, prepared.features, prepared.target)
    report.coalesce(1).write.mode("overwrite").json(f"{out}/quality")
    pairs = pair_correlations(written, prepared.features).where("i < j")
    near_duplicate_pairs(pairs).coalesce(1).write.mode("overwrite").json(f"{out}/near_duplicate_pairs")
    for name, made in prepared.reports.items():
        made().coalesce(1).write.mode("overwrite").json(f"{out}/{name}")
    # counted while it was sent, not on what was read back
    check = verify_written(spark, f"{out}/matrix", [ROW_ID, *prepared.features, prepared.target], sent)
    return replace(prepared, table=written), check


def train_salary(
    spark: SparkSession,
    matrix: str,
    out: str,
    model_type: str = "ridge",
    n_features: int = 15,
    test_percent: int = 20,
    target: str = v.SALARY_NUMBER,
) -> SalaryModel:
    """Train, evaluate and save a regression on a written matrix."""
    table = read_matrix(spark, matrix)
    features, _ = split_target(table, target, ignore=[ROW_ID])
    result = train_salary_model(Prepared(table, features, target, ROW_ID), model_type, n_features, test_percent)
    save_linear(spark, result.fit, out, result.correlations)
    return result


def train_levels(
    records: DataFrame,
    matrix: str,
    out: str,
    model_types: Sequence[str] = MODEL_TYPES,
    target: str = v.SALARY_NUMBER,
    **training,
) -> dict[str, SeniorityResult]:
    """Label the records, train the classifiers on their matrix rows, save models and one report."""
    spark = records.sparkSession
    table = read_matrix(spark, matrix)
    features, _ = split_target(table, target, ignore=[ROW_ID])
    labelled = classification_set(table, records, ROW_ID)
    results = train_seniority_models(labelled, features, ROW_ID, model_types=model_types, **training)
    for result in results.values():
        save_classifier(spark, result.fit, out, result)
    if any(r.per_class is not None for r in results.values()):
        write_class_report(compare_models(results), f"{out}/report")
        averages = [averaged_metrics(r.per_class).withColumn("model_type", F.lit(k)) for k, r in results.items() if r.per_class is not None]
        write_class_report(averages, f"{out}/averages")
    training = [r.training_accuracy.withColumn("model_type", F.lit(k)) for k, r in results.items()]
    write_class_report(training, f"{out}/training_accuracy")
    write_class_report(class_distribution(labelled, "level"), f"{out}/distribution")
    return results
