from checks.tables import resumes
from rowmill.plans import resume_values as v
from rowmill.plans.prepare import improved
from rowmill.plans.programs import prepare_records, read_records, train_levels, train_salary
from rowmill.sources.csv import read_csv, write_csv
from rowmill.sources.models import load_classifier, load_linear
from rowmill.operators.linear import predict

SF = "/root/testdata/sf0.001"


def test_files_to_models(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(resumes(spark, SF).withColumnRenamed("row_id", ""), source)
    records = read_records(spark, source)
    assert dict(records.dtypes)["row_id"] == "bigint"
    prepared, check = prepare_records(records, improved(), out)
    assert check.first()["rows_match"] and check.first()["columns_match"]
    assert spark.read.json(f"{out}/quality").first()["x_missing"] == 0

    result = train_salary(spark, f"{out}/matrix", f"{out}/salary", "lasso", n_features=12)
    saved = load_linear(spark, f"{out}/salary")
    assert saved.features == result.fit.features and len(saved.features) == 12
    amounts = predict(prepared.table, saved.model, saved.features)
    assert amounts.filter("prediction < 10000").isEmpty()

    results = train_levels(records, f"{out}/matrix", f"{out}/levels", trees=5, max_depth=4)
    assert set(results) == {"logistic", "random_forest"}
    assert read_csv(spark, f"{out}/levels/report").count() == 6
    assert load_classifier(spark, f"{out}/levels", "random_forest").classes == v.LEVELS


def test_generated_ids_are_stable(spark, tmp_path):
    source = str(tmp_path / "in")
    write_csv(resumes(spark, SF).drop("row_id").repartition(3), source)
    records = read_records(spark, source)
    first, second = records.collect(), records.collect()
    assert sorted(map(str, first)) == sorted(map(str, second))
    assert len({r["row_id"] for r in first}) == len(first)


def test_reports_of_the_jobs(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(resumes(spark, SF).withColumnRenamed("row_id", ""), source)
    records = read_records(spark, source)
    prepared, check = prepare_records(records, improved(), out)
    assert check.first()["rows"] == spark.read.parquet(f"{out}/matrix").count()
    assert spark.read.json(f"{out}/near_duplicate_pairs").first()["near_duplicate_pairs"] >= 0
    reduced = spark.read.json(f"{out}/reduction").first()
    assert reduced["rows_before"] == reduced["rows_after"] + reduced["rows_saved"]
    outliers = spark.read.json(f"{out}/outliers").collect()
    assert outliers and all(0 <= r["percent"] <= 100 for r in outliers)
    amounts = {r["stage"]: r for r in spark.read.json(f"{out}/amounts").collect()}
    assert amounts["before"]["max"] > amounts["after"]["max"] > amounts["after"]["median"] > 0
    train_levels(records, f"{out}/matrix", f"{out}/levels", ["random_forest"], trees=3, max_depth=4, forest_rows=400)
    averages = read_csv(spark, f"{out}/levels/averages")
    assert {r["average"] for r in averages.collect()} == {"macro", "weighted"}
    assert 0 < read_csv(spark, f"{out}/levels/training_accuracy").first()["accuracy"] <= 1
    assert abs(sum(r["percent"] for r in read_csv(spark, f"{out}/levels/distribution").collect()) - 100) < 1e-6


def test_ids_of_several_files_are_told_apart(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f",x\n0,{name}0\n1,{name}1\n")
    records = read_records(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert len({r["row_id"] for r in records.collect()}) == 4
