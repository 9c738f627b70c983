"""Regressions on one or two features, where SQL can state the solution: penalties, weights, nested scores, saved models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.table_queries import hash_sql, rounded
from checks.tables import query, table
from rowmill.operators.linear import FOLDS, L1_SHARE, PATH_LENGTH, PATH_RATIO, RIDGE_ALPHAS, LinearFit, coefficient_table, cv_summary, predict, train_linear
from rowmill.plans.seniority import train_seniority_models
from rowmill.sources.csv import read_csv
from rowmill.sources.models import load_evaluation, load_linear, save_classifier, save_linear
from rowmill.storage import new_path

X1, X2, NOISE = "size", "phase", "week"


def sized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label made of a strong, a weak and a hidden part, beside a feature that has nothing to do with it."""
    k = F.col("p_partkey")
    y = F.col("p_size") * 0.05 + (k % 97) * 0.002 + ((k * 37) % 11) / 10 + 9
    return table(spark, sf_dir, "part").select(k.alias("row_id"), F.col("p_size").cast("double").alias(X1), (k % 97).cast("double").alias(X2), (k % 7).cast("double").alias(NOISE), y.alias("label"))


def ridge_fit(spark: SparkSession, sf_dir: str) -> LinearFit:
    """Two of three features: the strongest ones."""
    return train_linear(sized_parts(spark, sf_dir), [NOISE, X2, X1], "label", "row_id", "ridge", n_features=2)


NAMES = ["a", "b", "y"]
PAIRS = [(u, w) for i, u in enumerate(NAMES) for w in NAMES[i:]]
SUMS = ["n", *[f"s{u}" for u in NAMES], *[f"p{u}{w}" for u, w in PAIRS]]
ROWS_SQL = f"""rows AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, (p_partkey % 97)::DOUBLE AS b,
  p_size * 0.05 + (p_partkey % 97) * 0.002 + ((p_partkey * 37) % 11) / 10 + 9 AS y,
  {hash_sql("'fold:' || CAST(p_partkey AS VARCHAR)")} % {FOLDS} AS o, {hash_sql("'inner fold:' || CAST(p_partkey AS VARCHAR)")} % {FOLDS} AS i FROM part),
cells AS (SELECT o, i, count(*)::DOUBLE AS n, {', '.join(f'sum({u}) AS s{u}' for u in NAMES)}, {', '.join(f'sum({u} * {w}) AS p{u}{w}' for u, w in PAIRS)} FROM rows GROUP BY o, i),
total AS (SELECT {', '.join(f'sum({c}) AS {c}' for c in SUMS)} FROM cells),
folds AS (SELECT o, {', '.join(f'sum({c}) AS {c}' for c in SUMS)} FROM cells GROUP BY o),
rests AS (SELECT o, {', '.join(f'total.{c} - folds.{c} AS {c}' for c in SUMS)} FROM folds, total),
alphas AS (SELECT unnest({RIDGE_ALPHAS}::DOUBLE[]) AS alpha)"""


def _about(t: str, u: str, w: str) -> str:
    """Sum of products about the means of the rows of ``t``."""
    return f"({t}.p{u}{w} - {t}.s{u} * {t}.s{w} / {t}.n)"


def _sd(t: str, u: str) -> str:
    return f"sqrt({_about(t, u, u)} / {t}.n)"


def _weight(t: str, scale: str, which: str) -> str:
    """Ridge weight of a feature that is divided by its deviation in ``scale``, by Cramer's rule."""
    aa, bb, ab = (f"({_about(t, u, w)} / ({_sd(scale, u)} * {_sd(scale, w)}))" for u, w in (("a", "a"), ("b", "b"), ("a", "b")))
    ay, by = (f"({_about(t, u, 'y')} / {_sd(scale, u)})" for u in "ab")
    own, other, pull, pushed = (aa, bb, ay, by) if which == "a" else (bb, aa, by, ay)
    return f"(({pull}) * ({other} + alpha) - {ab} * ({pushed})) / (({own} + alpha) * ({other} + alpha) - {ab} * {ab})"


def _r2(h: str, t: str, scale: str) -> str:
    """R² on the rows of ``h`` with weights ``wa``, ``wb`` and the intercept from the means of ``t``."""
    def product(u: str, w: str) -> str:
        return f"({_about(h, u, w)} + {h}.n * ({h}.s{u} / {h}.n - {t}.s{u} / {t}.n) * ({h}.s{w} / {h}.n - {t}.s{w} / {t}.n))"

    wa, wb = (f"(w{u} / {_sd(scale, u)})" for u in "ab")
    error = f"{product('y', 'y')} - 2 * ({wa} * {product('a', 'y')} + {wb} * {product('b', 'y')}) + {wa} * {wa} * {product('a', 'a')} + {wb} * {wb} * {product('b', 'b')} + 2 * {wa} * {wb} * {product('a', 'b')}"
    return f"1 - ({error}) / {_about(h, 'y', 'y')}"


RIDGE_SQL = f"""WITH {ROWS_SQL},
tried AS (SELECT o, alpha, {_weight('rests', 'total', 'a')} AS wa, {_weight('rests', 'total', 'b')} AS wb FROM rests, total, alphas),
scores AS (SELECT alpha, avg({_r2('folds', 'rests', 'total')}) AS r2 FROM tried JOIN folds USING (o) JOIN rests USING (o), total GROUP BY alpha),
best AS (SELECT alpha FROM scores ORDER BY r2 DESC, alpha LIMIT 1),
ridge AS (SELECT alpha, {_weight('total', 'total', 'a')} AS wa, {_weight('total', 'total', 'b')} AS wb FROM best, total)"""

# The whole procedure without one fold after the other: scaling, penalty and weights from the others, R² on the fold.
NESTED_SQL = f"""{RIDGE_SQL},
inner_cells AS (SELECT f.o AS fold, c.i, {', '.join(f'sum(c.{s}) AS {s}' for s in SUMS)} FROM folds f JOIN cells c ON c.o <> f.o GROUP BY f.o, c.i),
inner_rests AS (SELECT fold, c.i, {', '.join(f'r.{s} - c.{s} AS {s}' for s in SUMS)} FROM inner_cells c JOIN rests r ON r.o = fold),
inner_tried AS (SELECT t.fold, t.i, alpha, {_weight('t', 'r', 'a')} AS wa, {_weight('t', 'r', 'b')} AS wb FROM inner_rests t JOIN rests r ON r.o = t.fold, alphas),
inner_scores AS (SELECT w.fold, w.alpha, avg({_r2('h', 't', 'r')}) AS r2 FROM inner_tried w JOIN inner_cells h ON h.fold = w.fold AND h.i = w.i
  JOIN inner_rests t ON t.fold = w.fold AND t.i = w.i JOIN rests r ON r.o = w.fold GROUP BY w.fold, w.alpha),
chosen AS (SELECT fold, alpha FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY r2 DESC, alpha) AS place FROM inner_scores) WHERE place = 1),
outer_fits AS (SELECT fold, {_weight('r', 'r', 'a')} AS wa, {_weight('r', 'r', 'b')} AS wb FROM chosen JOIN rests r ON r.o = fold),
outer_scores AS (SELECT {_r2('h', 'r', 'r')} AS r2 FROM outer_fits w JOIN folds h ON h.o = fold JOIN rests r ON r.o = fold)"""


@query("q_ridge_two_features", f"{NESTED_SQL} SELECT alpha, round((SELECT avg(r2) FROM outer_scores), 6) AS cv_r2_mean, round((SELECT stddev_pop(r2) FROM outer_scores), 6) AS cv_r2_std FROM ridge")
def ridge_two_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = ridge_fit(spark, sf_dir)
    return rounded(cv_summary(spark, fit).select(F.lit(fit.alpha).alias("alpha"), "cv_r2_mean", "cv_r2_std"), 6, "cv_r2_mean", "cv_r2_std")


COEFFICIENTS_SQL = f"""{RIDGE_SQL}, listed AS (SELECT '{X1}' AS feature, wa AS coefficient FROM ridge UNION ALL SELECT '{X2}', wb FROM ridge)
SELECT feature, round(coefficient, 6) AS coefficient, round(abs(coefficient), 6) AS abs_coefficient, row_number() OVER (ORDER BY abs(coefficient) DESC) AS importance_rank,
CASE WHEN coefficient > 0 THEN 'increases' ELSE 'decreases' END AS impact FROM listed"""


@query("q_ridge_coefficients", COEFFICIENTS_SQL)
def ridge_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = ridge_fit(spark, sf_dir)
    ranked = coefficient_table(spark, fit.features, fit.coefficients).withColumn("importance_rank", F.col("importance_rank").cast("bigint"))
    return rounded(ranked, 6, "coefficient", "abs_coefficient")


@query("q_saved_coefficients", COEFFICIENTS_SQL)
def saved_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coefficient table that is saved with a model."""
    path = new_path(spark, "ridge")
    save_linear(spark, ridge_fit(spark, sf_dir), path)
    return rounded(read_csv(spark, f"{path}/coefficients"), 6, "coefficient", "abs_coefficient")


@query(
    "q_saved_ridge_scores",
    f"""{RIDGE_SQL} SELECT id AS row_id, round(greatest(exp(total.sy / n + wa * (a - sa / n) / {_sd('total', 'a')} + wb * (b - sb / n) / {_sd('total', 'b')}) - 1, 10000.0), 2) AS prediction
    FROM rows, ridge, total""",
)
def saved_ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model, read back, scores a table that has no label and another order of columns."""
    path = new_path(spark, "ridge")
    save_linear(spark, ridge_fit(spark, sf_dir), path)
    fit = load_linear(spark, path)
    unlabelled = sized_parts(spark, sf_dir).select("row_id", NOISE, X2, X1)
    return rounded(predict(unlabelled, fit.model, fit.features).select("row_id", "prediction"), 2, "prediction")


@query(
    "q_training_report",
    f"""{RIDGE_SQL} SELECT 'model parameters' AS section, 0 AS position, 'best alpha' AS metric, CAST(alpha AS VARCHAR) AS value FROM ridge
    UNION ALL SELECT 'selected features', 0, '1', '{X1}' UNION ALL SELECT 'selected features', 1, '2', '{X2}'""",
)
def saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ridge")
    save_linear(spark, ridge_fit(spark, sf_dir), path)
    return spark.read.json(f"{path}/report").select("section", F.col("position").cast("int"), "metric", "value")


def _soft_sql(model_type: str) -> str:
    """One feature: the weight is the covariance moved towards zero, over the variance; the penalty has the least held-out error."""
    share = L1_SHARE[model_type]

    def moved(t: str, scale: str) -> str:
        c = f"({_about(t, 'a', 'y')} / {t}.n / {_sd(scale, 'a')})"
        return f"sign({c}) * greatest(abs({c}) - penalty * {share}, 0) / ({_about(t, 'a', 'a')} / {t}.n / ({_sd(scale, 'a')} * {_sd(scale, 'a')}) + penalty * {1 - share})"

    def product(u: str, w: str) -> str:
        return f"({_about('h', u, w)} + h.n * (h.s{u} / h.n - t.s{u} / t.n) * (h.s{w} / h.n - t.s{w} / t.n))"

    scaled = f"(w / {_sd('total', 'a')})"
    return f"""WITH {ROWS_SQL}, path AS (SELECT range AS k, abs({_about('total', 'a', 'y')} / n / {_sd('total', 'a')}) / {share} * pow({PATH_RATIO}, range / {PATH_LENGTH - 1}::DOUBLE) AS penalty FROM range({PATH_LENGTH}), total),
    tried AS (SELECT t.o, k, penalty, {moved('t', 'total')} AS w FROM rests t, total, path),
    errors AS (SELECT k, penalty, avg(({product('y', 'y')} - 2 * {scaled} * {product('a', 'y')} + {scaled} * {scaled} * {product('a', 'a')}) / h.n) AS e
      FROM tried JOIN folds h USING (o) JOIN rests t USING (o), total GROUP BY k, penalty),
    best AS (SELECT penalty FROM errors ORDER BY e, k LIMIT 1)
    SELECT round(penalty, 6) AS alpha, round({moved('total', 'total')}, 5) AS coefficient FROM best, total"""


def _one_feature(spark: SparkSession, sf_dir: str, model_type: str) -> DataFrame:
    fit = train_linear(sized_parts(spark, sf_dir), [X1], "label", "row_id", model_type)
    return spark.createDataFrame([(round(fit.alpha, 6), round(fit.coefficients[0], 5))], "alpha double, coefficient double")


@query("q_lasso_one_feature", _soft_sql("lasso"))
def lasso_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_feature(spark, sf_dir, "lasso")


@query("q_elasticnet_one_feature", _soft_sql("elasticnet"))
def elasticnet_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_feature(spark, sf_dir, "elasticnet")


TEST_SQL = """t AS (SELECT CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS class,
  row_number() OVER (PARTITION BY p_size > 25 ORDER BY md5(CAST(p_partkey AS VARCHAR))) AS place, count(*) OVER (PARTITION BY p_size > 25) AS n FROM part)"""


@query(
    "q_saved_evaluation",
    f"WITH {TEST_SQL} SELECT class, count(*) AS support, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS test_accuracy, 1.0::DOUBLE AS training_accuracy FROM t WHERE place <= floor(n * 0.3 + 1e-9) GROUP BY class",
)
def saved_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest on classes that a feature tells apart: what is saved with it, after a second save that failed half way."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), (size > 25).cast("double").alias("large"), (F.col("p_partkey") % 7).cast("double").alias(NOISE), F.when(size > 25, "big").otherwise("small").alias("level"))
    result = train_seniority_models(rows, ["large", NOISE], "row_id", model_types=["random_forest"], trees=5, max_depth=4)["random_forest"]
    path = new_path(spark, "forest")
    save_classifier(spark, result.fit, path, result)
    result.fit.model.write().save(f"{path}/random_forest/unfinished/model")  # a version that is not in the list
    saved = load_evaluation(spark, path, "random_forest")
    return saved.select(F.inline("per_class"), "test_accuracy", "training_accuracy").select("class", "support", "recall", "test_accuracy", "training_accuracy")
