import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rowmill.operators.classify import (
    class_weights,
    classify,
    decode_labels,
    encode_labels,
    train_classifier,
    with_class_weights,
)
from rowmill.operators.evaluate import averaged_metrics, class_metrics, regression_metrics
from rowmill.operators.linear import (
    RIDGE_ALPHAS,
    coefficient_table,
    predict,
    train_linear,
)
from rowmill.operators.moments import grouped_products
from rowmill.operators.split import row_hash
from rowmill.plans.seniority import compare_models, train_seniority_models

FEATURES = ["x0", "x1", "x2", "x3", "x4"]


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(7)
    n = 600
    x = rng.normal(size=(n, 5)) * [1, 10, 0.1, 5, 1] + [0, 100, 0, -3, 2]
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=n) * 0.3
    y = 12 + 0.4 * x[:, 0] - 0.02 * x[:, 1] + 3 * x[:, 2] + rng.normal(size=n) * 0.4
    frame = pd.DataFrame(x, columns=FEATURES).assign(row_id=np.arange(n), y=y)
    df = spark.createDataFrame(frame).repartition(4)
    hashed = df.select("row_id", *[(row_hash(F.col("row_id"), s) % 5).alias(c) for s, c in (("fold:", "f"), ("inner fold:", "g"))])
    return df, frame.merge(hashed.toPandas(), on="row_id")


def _standard(x, like):
    std = like.std(axis=0)
    return (x - like.mean(axis=0)) / np.where(std > 0, std, 1)


def _ridge(x, y, alpha):
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - w @ x.mean(axis=0)


def _r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def _best_alpha(x, y, folds):
    scores = []
    for alpha in RIDGE_ALPHAS:
        parts = []
        for f in range(5):
            w, b = _ridge(x[folds != f], y[folds != f], alpha)
            parts.append(_r2(y[folds == f], x[folds == f] @ w + b))
        scores.append(np.mean(parts))
    return RIDGE_ALPHAS[int(np.argmax(scores))]


def test_ridge_matches_a_row_by_row_cross_validation(regression):
    df, frame = regression
    fit = train_linear(df, FEATURES, "y", "row_id", "ridge")
    x, y = frame[FEATURES].to_numpy(), frame.y.to_numpy()
    z = _standard(x, x)
    alpha = _best_alpha(z, y, frame.f.to_numpy())
    assert fit.alpha == alpha and fit.features == FEATURES
    assert fit.coefficients == pytest.approx(list(_ridge(z, y, alpha)[0]), abs=1e-8)
    scores = []
    for f in range(5):
        held = (frame.f == f).to_numpy()
        train = _standard(x[~held], x[~held])
        w, b = _ridge(train, y[~held], _best_alpha(train, y[~held], frame.g.to_numpy()[~held]))
        scores.append(_r2(y[held], _standard(x[held], x[~held]) @ w + b))
    assert fit.cv_scores == pytest.approx(scores, abs=1e-8)
    assert fit.cv_std == pytest.approx(np.std(scores), abs=1e-8)


@pytest.mark.parametrize("model_type,share", [("lasso", 1.0), ("elasticnet", 0.5)])
def test_sparse_models_meet_the_optimality_conditions(regression, model_type, share):
    df, frame = regression
    fit = train_linear(df, FEATURES, "y", "row_id", model_type)
    x, y = frame[FEATURES].to_numpy(), frame.y.to_numpy()
    z, n, w = _standard(x, x), len(y), np.array(fit.coefficients)
    residual = (y - y.mean()) - z @ w
    gradient = z.T @ residual / n - fit.alpha * (1 - share) * w
    bound = fit.alpha * share
    active = np.abs(w) > 1e-9
    assert np.allclose(gradient[active], bound * np.sign(w[active]), atol=1e-6)
    assert (np.abs(gradient[~active]) <= bound + 1e-6).all()
    # the penalty is one of the hundred on the path
    top = np.abs(z.T @ (y - y.mean())).max() / n / share
    assert np.isclose(np.geomspace(top, top / 1000, 100), fit.alpha, rtol=1e-9).any()
    assert len(fit.cv_scores) == 5 and 0.5 < fit.cv_mean < 1


def test_unknown_model_type(regression):
    with pytest.raises(ValueError):
        train_linear(regression[0], FEATURES, "y", "row_id", "stepwise")


def test_feature_selection_and_prediction(regression, spark):
    df, frame = regression
    fit = train_linear(df, FEATURES, "y", "row_id", "ridge", n_features=2)
    strength = {c: abs(np.corrcoef(frame[c], frame.y)[0, 1]) for c in FEATURES}
    assert fit.features == sorted(strength, key=strength.get, reverse=True)[:2]
    logs = predict(df, fit.model, fit.features, as_log=True)
    assert set(logs.columns) == {*df.columns, "prediction"}
    amounts = predict(df, fit.model, fit.features).agg(F.min("prediction"), F.max("prediction")).first()
    highest = np.expm1(logs.agg(F.max("prediction")).first()[0])
    assert amounts[0] == 10_000.0 and amounts[1] == pytest.approx(highest)
    narrow = predict(df.select(*fit.features), fit.model, fit.features, as_log=True)
    assert narrow.count() == len(frame)
    table = coefficient_table(spark, fit.features, fit.coefficients).orderBy("importance_rank").collect()
    assert [r["importance_rank"] for r in table] == [1, 2]
    assert table[0]["abs_coefficient"] >= table[1]["abs_coefficient"]
    unnamed = coefficient_table(spark, ["only one"], [1.0, -2.0]).orderBy("importance_rank").collect()
    assert [(r["feature"], r["impact"]) for r in unnamed] == [("feature_1", "decreases"), ("feature_0", "increases")]


def test_grouped_products_are_matrix_products(regression):
    df, frame = regression
    folded = df.withColumn("fold", (F.col("row_id") % 3).cast("int"))
    for fold, m in grouped_products(folded, [F.col(c) for c in FEATURES], F.col("fold")).items():
        rows = frame[frame["row_id"] % 3 == fold][FEATURES].to_numpy(dtype="float64")
        own = np.column_stack([np.ones(len(rows)), rows])
        assert np.allclose(m, own.T @ own)


def test_regression_metrics(spark):
    y, p = np.array([0.0, 5.0, 9.0, 10.0]), np.array([0.1, 5.1, 8.0, 10.2])
    row = regression_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    amount, guess = np.expm1(y), np.expm1(p)
    amount[0] = 1e-10  # an exact zero becomes a tiny number
    relative = np.abs(amount - guess) / np.maximum(amount, 1e-10)
    assert row["mae_log"] == pytest.approx(np.abs(y - p).mean())
    assert row["r2_log"] == pytest.approx(_r2(y, p)) and row["r2_amount"] == pytest.approx(_r2(amount, guess))
    assert row["rmse_amount"] == pytest.approx(np.sqrt(((amount - guess) ** 2).mean()))
    assert row["mape"] == pytest.approx(relative.mean() * 100)
    assert row["within_20_pct"] == pytest.approx((relative < 0.2).mean() * 100)
    assert row["within_30_pct"] == pytest.approx((relative < 0.3).mean() * 100)
    assert (row["zero_actuals"], row["zero_predictions"]) == (1, 0)


def test_class_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    per_class = class_metrics(spark.createDataFrame(pairs, "y string, p string"), "y", "p")
    rows = {r["class"]: r for r in per_class.collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["support"]) == (0.75, 0.75, 4)
    assert rows["b"]["precision"] == pytest.approx(2 / 3) and rows["b"]["recall"] == 1.0
    assert rows["b"]["f1"] == pytest.approx(0.8)
    assert (rows["c"]["precision"], rows["c"]["recall"], rows["c"]["f1"]) == (0.0, 0.0, 0.0)
    averages = {r["average"]: r for r in averaged_metrics(per_class).collect()}
    assert averages["macro"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert averages["weighted"]["precision"] == pytest.approx((0.75 * 4 + 2 / 3 * 2) / 7)
    assert averages["macro"]["accuracy"] == pytest.approx(5 / 7) and averages["macro"]["support"] == 7


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(11)
    n = 500
    label = rng.choice(["junior", "middle", "senior"], size=n, p=[0.1, 0.65, 0.25])
    shift = pd.Series(label).map({"junior": -1.0, "middle": 0.0, "senior": 1.2}).to_numpy()
    frame = pd.DataFrame(
        {"row_id": np.arange(n), "u": shift + rng.normal(size=n), "w": 50 * (shift + rng.normal(size=n) * 2), "level": label}
    )
    return spark.createDataFrame(frame), frame


def _newton(z, t, weight, rounds=60):
    """Weighted logistic regression with half squared norm of the weights, intercept free."""
    x = np.column_stack([np.ones(len(z)), z])
    penalty = np.diag([0.0] + [1.0] * z.shape[1])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        b -= np.linalg.solve(h, x.T @ (weight * (p - t)) + penalty @ b)
    return b


def test_logistic_matches_newton(classes):
    df, frame = classes
    fit = train_classifier(df, ["u", "w"], "level", "logistic")
    counts = frame.level.value_counts()
    expected = {c: len(frame) / (3 * counts[c]) for c in counts.index}
    assert fit.weights == {c: pytest.approx(expected[c]) for c in expected}
    z = _standard(frame[["u", "w"]].to_numpy(), frame[["u", "w"]].to_numpy())
    weight = frame.level.map(expected).to_numpy()
    for i, name in enumerate(fit.classes):
        model = fit.model.stages[3].models[i]
        b = _newton(z, (frame.level == name).to_numpy().astype(float), weight)
        assert [model.intercept, *model.coefficients] == pytest.approx(list(b), abs=2e-3)


@pytest.mark.parametrize("model_type", ["logistic", "random_forest"])
def test_classifiers_score_unlabelled_rows(classes, model_type):
    df, frame = classes
    fit = train_classifier(df, ["u", "w"], "level", model_type, trees=10, max_depth=5)
    scored = classify(df.drop("level"), fit.model, fit.features)
    assert scored.columns == ["row_id", "u", "w", "predicted"]
    merged = scored.toPandas().merge(frame[["row_id", "level"]], on="row_id")
    if model_type == "logistic":  # the class whose own model is surest
        z = _standard(merged[["u", "w"]].to_numpy(), frame[["u", "w"]].to_numpy())
        models = fit.model.stages[3].models
        margins = np.column_stack([z @ m.coefficients.toArray() + m.intercept for m in models])
        assert list(merged.predicted) == [fit.classes[i] for i in margins.argmax(axis=1)]
    else:  # clearly better than guessing for every class on average
        recalls = (merged.predicted == merged.level).groupby(merged.level).mean()
        assert recalls.mean() > 0.5


@pytest.mark.parametrize("model_type, least", [("logistic", 1), ("logistic", 3), ("random_forest", 1), ("random_forest", 3)])
def test_classifiers_score_in_a_session_that_observes(classes, model_type, least):
    df, frame = classes
    seen = Observation()
    assert df.observe(seen, F.count(F.lit(1)).alias("rows")).count() == seen.get["rows"]
    levels = sorted(set(frame.level))[:least]
    known = df.filter(F.col("level").isin(levels))
    fit = train_classifier(known, ["u", "w"], "level", model_type, trees=3, max_depth=3)
    assert set(classify(known, fit.model, fit.features).toPandas().predicted) == set(levels)


def test_compare_models_in_a_session_that_observes(classes):
    df, _ = classes
    assert df.observe(Observation(), F.count(F.lit(1)).alias("rows")).count() > 0
    table = compare_models(train_seniority_models(df, ["u", "w"], "row_id", trees=3, max_depth=3)).toPandas()
    assert set(table.model_type) == {"logistic", "random_forest"}


def test_two_classes_compared_in_a_session_that_observes(classes):
    df, _ = classes
    assert df.observe(Observation(), F.count(F.lit(1)).alias("rows")).count() > 0
    marked = df.withColumn("quality", (F.col("u") > 0).cast("int").cast("string"))
    table = compare_models(train_seniority_models(marked, ["u", "w"], "row_id", "quality", ["logistic"])).toPandas()
    assert set(table["class"]) == {"0", "1"} and (table.f1 > 0.9).all()


def test_compare_models(classes):
    df, frame = classes
    results = train_seniority_models(df, ["u", "w"], "row_id", trees=5, max_depth=4)
    table = compare_models(results).toPandas()
    assert set(table.model_type) == {"logistic", "random_forest"}
    test_rows = sum(int(0.3 * n) for n in frame.level.value_counts())
    assert (table.groupby("model_type").support.sum() == test_rows).all()
    tiny = train_seniority_models(df.limit(20), ["u", "w"], "row_id", model_types=["logistic"])
    assert tiny["logistic"].per_class is None
    with pytest.raises(ValueError):
        train_classifier(df, ["u"], "level", "boosting")
    with pytest.raises(ValueError):
        train_classifier(df.filter("false"), ["u"], "level")


def test_class_weights_and_codes(classes):
    df, frame = classes
    weights = {r["class"]: r["weight"] for r in class_weights(df, "level").collect()}
    weighted = with_class_weights(df, "level", weights)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(len(frame))
    names = ["senior", "junior", "middle"]
    coded = df.select("level", encode_labels(F.col("level"), names).alias("code"))
    assert {tuple(r) for r in coded.distinct().collect()} == {("junior", 0), ("middle", 1), ("senior", 2)}
    assert coded.filter(decode_labels(F.col("code"), names) != F.col("level")).isEmpty()
