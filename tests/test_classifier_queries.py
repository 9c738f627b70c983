"""Classifier queries have no SQL of their own; their classes and test rows follow from counts that have."""

import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name, counts, model_types",
    [
        ("q_model_compare", "q_level_distribution", ["logistic", "random_forest"]),
        ("q_quality_logistic", "q_class_weights", ["logistic"]),
    ],
)
def test_reports_in_a_session_that_observes(spark, name, counts, model_types):
    assert spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("rows")).count() == 3
    queries = entry_point.queries()
    held_out = {str(r["class"]): math.floor(r["rows"] * 0.3 + 1e-9) for r in queries[counts](spark, SF).collect()}
    rows = queries[name](spark, SF).collect()
    assert sorted((r["model_type"], r["class"], r["support"]) for r in rows) == [
        (model_type, c, held_out[c]) for model_type in model_types for c in sorted(held_out)
    ]
