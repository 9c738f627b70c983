from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.tables import resumes
from rowmill.plans import resume_values as v
from rowmill.plans.prepare import improved, prepare, simple
from rowmill.plans.salary import train_salary_model
from rowmill.plans.seniority import classification_set, train_seniority_models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return resumes(spark, SF)


@pytest.fixture(scope="module")
def prepared(raw):
    return prepare(raw, improved(), "row_id")


def test_improved_table(prepared):
    table = prepared.table
    assert table.columns == ["row_id", *prepared.features, v.SALARY_NUMBER]
    assert not {v.SALARY, v.SALARY_BASE, "row_id"} & set(prepared.features)
    assert {kind for _, kind in table.drop("row_id").dtypes} == {"double"}
    gaps = table.agg(*[F.count_if(F.col(f"`{c}`").isNull()) for c in table.columns]).first()
    assert set(gaps) == {0}
    # sorted categories, the first one dropped
    groups = [f for f in prepared.features if f.startswith(v.GENDER + "_")]
    assert groups == ["Пол_Мужчина", "Пол_Не указано"]
    scaled = [c for c in prepared.fitted.scaled]
    stats = table.agg(*[F.avg(f"`{c}`") for c in scaled], *[F.stddev_pop(f"`{c}`") for c in scaled]).first()
    assert list(stats[: len(scaled)]) == pytest.approx([0.0] * len(scaled), abs=1e-9)
    assert all(s == pytest.approx(1.0) or s == 0 for s in stats[len(scaled) :])


def test_fitted_preset_prepares_new_records(raw, prepared):
    again = prepared.fitted.apply(raw.filter("row_id < 50"))
    assert set(prepared.features) <= set(again.columns) and again.count() == 50
    once = {r["row_id"]: r for r in again.collect()}
    fitted = prepared.table.join(again.select("row_id"), "row_id").collect()
    for row in fitted:
        for name in prepared.features:
            assert float(once[row["row_id"]][name]) == pytest.approx(row[name]), name


def test_result_does_not_depend_on_partitions(raw, prepared):
    other = prepare(raw.repartition(7), improved(), "row_id")
    assert other.features == prepared.features
    a, b = (p.table.orderBy("row_id").toPandas() for p in (prepared, other))
    assert a.shape == b.shape and abs(a - b).max().max() < 1e-6


def test_published_variants(raw):
    published = prepare(raw, improved(published=True), "row_id")
    assert {v.SALARY_BASE, v.SALARY} & set(published.features)
    assert published.fitted.bounds == {}
    assert v.SALARY_NUMBER in published.fitted.scaled
    assert prepare(raw, simple(published=True), "row_id").table.columns[-1] == v.SALARY_NUMBER


def test_user_stage(raw):
    def city_length(df):
        return df.withColumn("city_length", F.length(v.CITY_CLEAN))

    options = replace(simple(), extra_stages=(city_length,))
    assert "city_length" in prepare(raw, options, "row_id").features


def test_missing_target_is_an_error(raw):
    with pytest.raises(ValueError):
        prepare(raw.drop(v.SALARY), simple(), "row_id")


def test_outlier_actions(raw):
    removed = prepare(raw, replace(improved(), outlier_action="remove", outlier_threshold=0.5), "row_id")
    clipped = prepare(raw, replace(improved(), outlier_detector="zscore"), "row_id")
    assert removed.table.count() < clipped.table.count()


def test_salary_model(prepared):
    result = train_salary_model(prepared, "ridge", n_features=10)
    assert len(result.fit.features) == 10 and result.coefficients.count() == 10
    assert result.correlations.count() <= 20 and result.examples.count() == 5
    row = result.metrics.first()
    assert row["quality"] in {"very poor", "moderate", "good", "excellent"}
    assert result.fit.metrics["best_alpha"] == result.fit.alpha


def test_seniority(raw, prepared):
    table = classification_set(prepared.table, raw, "row_id")
    assert {r["level_code"] for r in table.select("level_code").distinct().collect()} <= {0, 1, 2}
    results = train_seniority_models(table, prepared.features[:8], "row_id", model_types=["logistic"])
    assert results["logistic"].per_class.count() == 3
