"""``python -m rowmill prepare|salary|levels``: run a job on files with spark-submit or locally."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rowmill.operators.classify import MODEL_TYPES
from rowmill.plans.prepare import improved, simple
from rowmill.plans.programs import prepare_records, read_records, train_levels, train_salary
from rowmill.session import recommended


def main() -> None:
    parser = argparse.ArgumentParser(prog="rowmill")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("prepare", help="CSV records to a feature matrix")
    job.add_argument("csv")
    job.add_argument("out")
    job.add_argument("--multi-line", action="store_true", help="the CSV has quoted line breaks")
    job.add_argument("--simple", action="store_true")
    job.add_argument("--published", action="store_true")
    job = jobs.add_parser("salary", help="regression on a feature matrix")
    job.add_argument("matrix")
    job.add_argument("out")
    job.add_argument("--model-type", choices=["ridge", "lasso", "elasticnet"], default="ridge")
    job.add_argument("--n-features", type=int, default=15)
    job.add_argument("--test-percent", type=int, default=20)
    job = jobs.add_parser("levels", help="seniority classifiers on records and their matrix")
    job.add_argument("csv")
    job.add_argument("matrix")
    job.add_argument("out")
    job.add_argument("--multi-line", action="store_true", help="the CSV has quoted line breaks")
    job.add_argument("--model", choices=MODEL_TYPES, action="append")
    args = parser.parse_args()

    spark = recommended(SparkSession.builder.appName(f"rowmill {args.job}")).getOrCreate()
    if args.job == "prepare":
        options = (simple if args.simple else improved)(args.published)
        _, check = prepare_records(read_records(spark, args.csv, args.multi_line), options, args.out)
        check.show(truncate=False)
    elif args.job == "salary":
        result = train_salary(spark, args.matrix, args.out, args.model_type, args.n_features, args.test_percent)
        result.metrics.show(truncate=False, vertical=True)
        result.coefficients.show(truncate=False)
    else:
        results = train_levels(read_records(spark, args.csv, args.multi_line), args.matrix, args.out, args.model or MODEL_TYPES)
        for found in results.values():
            if found.per_class is not None:
                found.per_class.show()
    spark.stop()


if __name__ == "__main__":
    main()
