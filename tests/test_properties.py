from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import numpy as np
import pytest

from rowmill.functions.text import clean_text, extract_number
from rowmill.operators.outliers import fit_bounds, limit_to_bounds
from rowmill.operators.quantiles import exact_quantiles
from rowmill.operators.scale import apply_scaling, fit_standard

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
numbers = st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1, max_size=60)
texts = st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="﻿\x00")), min_size=1, max_size=40)


@few
@given(texts)
def test_cleaning_matches_plain_python_and_is_idempotent(spark, values):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i int, t string")
    once = df.withColumn("c", clean_text(F.col("t"))).withColumn("d", clean_text(F.col("c")))
    for row in once.collect():
        assert row["c"] == " ".join(values[row["i"]].split()) == row["d"]


@few
@given(st.lists(st.text("0123456789., руб$", max_size=12), min_size=1, max_size=40))
def test_numbers_match_plain_python(spark, values):
    def parse(text):
        kept = "".join(ch for ch in text if ch in "0123456789.,").replace(",", ".")
        try:
            return float(kept)
        except ValueError:
            return 0.0

    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i int, t string")
    for row in df.select("i", extract_number(F.col("t")).alias("x")).collect():
        assert row["x"] == parse(values[row["i"]])


@few
@given(numbers, st.sampled_from([2, 100_000]))
def test_quantiles(spark, values, few_values):
    df = spark.createDataFrame([(x,) for x in values], "x double")
    at = [0.0, 0.25, 0.5, 0.9, 1.0]
    assert exact_quantiles(df, ["x"], at, few_values)["x"] == pytest.approx(list(np.quantile(values, at)), rel=1e-9, abs=1e-9)


@few
@given(numbers)
def test_limited_values_lie_within_bounds_and_scaled_ones_have_unit_spread(spark, values):
    df = spark.createDataFrame([(x,) for x in values], "x double")
    bounds = fit_bounds(df, "iqr", 1.5, ["x"])
    low, high = bounds["x"]
    limited = [r["x"] for r in limit_to_bounds(df, bounds).collect()]
    assert all(low <= x <= high for x in limited)
    scaled = np.array([r["x"] for r in apply_scaling(df, fit_standard(df, ["x"])).collect()])
    assert abs(scaled.mean()) < 1e-6
    assert np.ptp(values) < 1e-6 or scaled.std() == pytest.approx(1.0, rel=1e-6)
