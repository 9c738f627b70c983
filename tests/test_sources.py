import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowmill.operators.linear import train_linear
from rowmill.operators.classify import classify, train_classifier
from rowmill.operators.correlation import strongest, target_correlations
from rowmill.operators.columns import union_all
from rowmill.sources.csv import read_csv
from rowmill.sources.matrix import read_matrix, verify_written, write_matrix
from rowmill.sources.metadata import feature_metadata, read_feature_names, write_feature_names
from rowmill.sources.models import (
    load_classifier,
    load_linear,
    save_classifier,
    save_linear,
    training_report,
    write_class_report,
)
from rowmill.storage import materialize, new_path, scratch_dir
from rowmill.streaming.files import append_features, csv_stream
from rowmill.plans import resume_values as v
from rowmill.plans.resume_features import basic_features, clean_table, with_base_currency

CSV = ''',"Пол, возраст",ЗП,n,mixed,empty
0,"Мужчина, 42 года","27 000 руб",1,1.5,
1,"Женщина,
 ""21 год""",NA,2,x,nan
2,nan,10 USD,3,,
'''


@pytest.fixture()
def csv_path(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV, encoding="utf-8")
    return str(tmp_path / "in")


def test_csv_with_inference(spark, csv_path):
    df = read_csv(spark, csv_path, multi_line=True)
    kinds = dict(df.dtypes)
    assert (kinds["_c0"], kinds["n"], kinds["mixed"], kinds["empty"]) == ("bigint", "bigint", "string", "double")
    rows = df.orderBy("_c0").collect()
    assert rows[1][v.GENDER_AGE] == 'Женщина,\n "21 год"'
    assert rows[1][v.SALARY] is None and rows[2][v.GENDER_AGE] is None and rows[2]["mixed"] is None


def test_csv_with_schema_and_many_files(spark, csv_path, tmp_path):
    (tmp_path / "in" / "b.csv").write_text(CSV.replace("\n0,", "\n7,"), encoding="utf-8")
    schema = f"_c0 long, `{v.GENDER_AGE}` string, `{v.SALARY}` string, n int, mixed string, empty string"
    df = read_csv(spark, csv_path, schema, multi_line=True)
    assert df.count() == 6 and df.filter("_c0 = 7").count() == 1
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "none"))


def test_stream_gives_the_batch_result(spark, csv_path, tmp_path):
    schema = f"_c0 long, `{v.GENDER_AGE}` string, `{v.SALARY}` string, n int, mixed string, empty string"
    stages = [clean_table, with_base_currency, basic_features]
    append_features(csv_stream(spark, csv_path, schema), stages, str(tmp_path / "out")).awaitTermination()
    batch = read_csv(spark, csv_path, schema)
    for stage in stages:
        batch = stage(batch)
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*[F.col(f"`{c}`") for c in batch.columns])
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_matrix_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(1, 2, True, 0.5), (2, 3, False, 0.7)], "row_id long, `a b` int, flag boolean, y double")
    write_matrix(df, path, ["a b", "flag"], "y", "row_id")
    check = verify_written(spark, path, ["row_id", "a b", "flag", "y"], 2).first()
    assert (check["rows_match"], check["columns_match"], check["columns"]) == (True, True, 4)
    assert not verify_written(spark, path, ["row_id"], 3).first()["rows_match"]
    assert set(dict(read_matrix(spark, path).drop("row_id").dtypes).values()) == {"double"}
    assert read_matrix(spark, path, ["id", "a"]).columns == ["id", "a", "feature_2", "feature_3"]


def test_feature_names(spark, tmp_path):
    path = str(tmp_path / "names")
    write_feature_names(spark, ["first: a", "second", "третий"], path)
    assert read_feature_names(spark, ["/nowhere", path], 3) == ["first: a", "second", "третий"]
    assert read_feature_names(spark, [f"{path}/json"], 4) == ["first: a", "second", "третий", "feature_3"]
    assert read_feature_names(spark, ["/nowhere"], 2) == ["feature_0", "feature_1"]
    meta = feature_metadata(spark.range(3).withColumn("s", F.lit("x"))).orderBy("position").collect()
    assert [(r["name"], r["dtype"], r["feature_count"], r["row_count"]) for r in meta] == [
        ("id", "bigint", 2, 3), ("s", "string", 2, 3),
    ]


@pytest.fixture(scope="module")
def rows(spark):
    x, z = F.rand(1), F.rand(2)
    df = spark.range(300).select(F.col("id").alias("row_id"), x.alias("x"), z.alias("z z"))
    return materialize(
        df.withColumn("y", 10 + F.col("x") - F.col("z z") * 2 + F.col("row_id") % 7 * 0.01).withColumn(
            "level", F.when(F.col("x") > 0.6, "high").otherwise("low")
        )
    )


def test_linear_model_round_trip(spark, rows, tmp_path):
    from dataclasses import replace

    path = str(tmp_path / "model")
    fit = replace(train_linear(rows, ["x", "z z"], "y", "row_id", "elasticnet"), metrics={"r2_log": 0.5})
    save_linear(spark, fit, path, strongest(target_correlations(rows, ["x", "z z"], "y"), 20))
    back = load_linear(spark, path)
    assert (back.features, back.alpha, back.metrics, back.l1_ratio) == (fit.features, fit.alpha, {"r2_log": 0.5}, 0.5)
    assert back.model.transform(rows).agg(F.sum("prediction")).first() == fit.model.transform(rows).agg(F.sum("prediction")).first()
    table = read_csv(spark, f"{path}/coefficients").orderBy("importance_rank").collect()
    assert [r["feature"] for r in table] == ["z z", "x"]
    sections = [r["section"] for r in spark.read.json(f"{path}/report").collect()]
    assert set(sections) == {"test metrics", "model parameters", "selected features"}
    many = replace(fit, features=[f"f{i}" for i in range(25)])
    last = training_report(spark, many).filter("metric = 'more'").first()
    assert last["value"] == "5"
    with pytest.raises(FileNotFoundError):
        load_linear(spark, str(tmp_path / "nothing"))


def test_classifier_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "classifiers")
    for model_type in ("logistic", "random_forest"):
        fit = train_classifier(rows, ["x", "z z"], "level", model_type, trees=3, max_depth=3)
        save_classifier(spark, fit, path)
        back = load_classifier(spark, path, model_type)
        assert (back.features, back.classes, back.weights) == (fit.features, fit.classes, fit.weights)
        counts = [classify(rows, f.model, f.features).groupBy("predicted").count().collect() for f in (fit, back)]
        assert sorted(counts[0]) == sorted(counts[1])
    report = spark.createDataFrame([("high", 0.5, "logistic")], "class string, precision double, model_type string")
    write_class_report([report, report], str(tmp_path / "report"))
    assert read_csv(spark, str(tmp_path / "report")).count() == 2


def test_storage(spark):
    assert new_path(spark, "x").startswith(scratch_dir(spark))
    df = spark.range(5).withColumnRenamed("id", "a, b: `c`")
    assert materialize(df).columns == df.columns and materialize(df).count() == 5


def test_union_all(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, union_all([a, b, b]).collect()), key=str) == sorted([(1, 2), (3, None), (3, None)], key=str)
