"""Regression, evaluation, labels, classifiers and whole presets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.table_queries import hash_sql, rounded
from checks.tables import RESUMES_SQL, TYPED_SQL, amount_sql, query, resumes, table
from checks.text_queries import treated_sql
from rowmill.functions.numeric import quality_band
from rowmill.functions.text import named
from rowmill.operators.classify import class_weights
from rowmill.operators.evaluate import (
    accuracy,
    averaged_metrics,
    class_distribution,
    class_metrics,
    regression_metrics,
    sample_predictions,
    to_amounts,
)
from rowmill.operators.joins import align
from rowmill.operators.labels import keep_labelled, keyword_hits
from rowmill.operators.linear import (
    LinearFit,
    coefficient_table,
    cv_summary,
    predict,
    train_linear,
)
from rowmill.operators.moments import grouped_products
from rowmill.operators.split import with_fold
from rowmill.operators.summary import value_summary
from rowmill.plans import resume_values as v
from rowmill.plans.prepare import improved, prepare, simple
from rowmill.plans.resume_features import LEVEL_RULES, advanced_features, basic_features
from rowmill.plans.salary import train_salary_model
from rowmill.plans.seniority import classification_set, compare_models, level_labels, train_seniority_models

# Regression on line items: log of the discounted price from quantity, price, discount and tax

REGRESSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    y = F.log1p(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return table(spark, sf_dir, "lineitem").select(key.alias("row_key"), *REGRESSORS, y.alias("label"))


def item_fit(spark: SparkSession, sf_dir: str, model_type: str) -> LinearFit:
    return train_linear(item_rows(spark, sf_dir), REGRESSORS, "label", "row_key", model_type, n_features=4)


def _gram_sql() -> str:
    z = ["l_quantity", "l_discount * 100", "l_tax * 100"]
    sums = [f"round(sum({x}), 2) AS s_{i}" for i, x in enumerate(z)]
    sums += [
        f"round(sum(({z[i]}) * ({z[j]})), 2) AS p_{i}_{j}" for i in range(len(z)) for j in range(i, len(z))
    ]
    key = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"
    return f"""SELECT CAST({hash_sql(f"'fold:' || {key}")} % 5 AS INTEGER) AS fold, count(*) AS n, {', '.join(sums)}
    FROM lineitem GROUP BY 1"""


@query("q_gram_by_fold", _gram_sql())
def gram_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = with_fold(item_rows(spark, sf_dir), "row_key")
    z = [F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    rows = [
        (fold, int(m[0, 0]), *[round(float(m[0, i + 1]), 2) for i in range(len(z))], *[round(float(m[i + 1, j + 1]), 2) for i, j in pairs])
        for fold, m in grouped_products(folded, z, F.col("fold")).items()
    ]
    names = [*[f"s_{i} double" for i in range(len(z))], *[f"p_{i}_{j} double" for i, j in pairs]]
    return spark.createDataFrame(rows, f"fold int, n long, {', '.join(names)}")


def _cv_rows(spark: SparkSession, fit: LinearFit) -> DataFrame:
    return cv_summary(spark, fit).select(
        F.lit(fit.model_type).alias("model_type"), F.lit(fit.alpha).alias("alpha"), "cv_r2_mean", "cv_r2_std"
    )


@query("q_ridge_cv")
def ridge_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv_rows(spark, item_fit(spark, sf_dir, "ridge"))


@query("q_lasso_cv")
def lasso_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv_rows(spark, item_fit(spark, sf_dir, "lasso"))


@query("q_elasticnet_cv")
def elasticnet_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv_rows(spark, item_fit(spark, sf_dir, "elasticnet"))


@query("q_coefficients")
def coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = item_fit(spark, sf_dir, "ridge")
    return coefficient_table(spark, fit.features, fit.coefficients)


@query("q_score_amounts")
def score_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = item_fit(spark, sf_dir, "ridge")
    return predict(item_rows(spark, sf_dir), fit.model, fit.features).select("row_key", "prediction")


# Evaluation of a fixed formula that stands in for a model


def guessed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.log1p("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        y.alias("y"),
        (y * 0.98 + 0.2 + (F.col("o_orderkey") % 7) * 0.01).alias("p"),
    )


GUESS_SQL = """WITH g AS (SELECT o_orderkey AS row_id, ln(1 + o_totalprice) AS y,
  ln(1 + o_totalprice) * 0.98 + 0.2 + (o_orderkey % 7) * 0.01 AS p FROM orders),
a AS (SELECT row_id, y, p, exp(y) - 1 AS v, exp(p) - 1 AS w, abs((exp(y) - exp(p)) / (exp(y) - 1)) AS rel FROM g)"""


@query(
    "q_regression_metrics",
    f"""{GUESS_SQL} SELECT round(avg(abs(y - p)), 6) AS mae_log, round(avg((y - p) ** 2), 6) AS mse_log,
      round(sqrt(avg((y - p) ** 2)), 6) AS rmse_log, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2_log,
      round(avg(abs(v - w)), 2) AS mae_amount, round(avg((v - w) ** 2), 0) AS mse_amount,
      round(sqrt(avg((v - w) ** 2)), 2) AS rmse_amount, round(1 - avg((v - w) ** 2) / var_pop(v), 6) AS r2_amount,
      round(avg(rel) * 100, 6) AS mape, round(count(*) FILTER (rel < 0.2) / count(*) * 100, 6) AS within_20_pct,
      round(count(*) FILTER (rel < 0.3) / count(*) * 100, 6) AS within_30_pct, 0 AS zero_predictions, 0 AS zero_actuals,
      CASE WHEN 1 - avg((v - w) ** 2) / var_pop(v) < 0.2 THEN 'very poor' WHEN 1 - avg((v - w) ** 2) / var_pop(v) < 0.4
        THEN 'moderate' WHEN 1 - avg((v - w) ** 2) / var_pop(v) < 0.6 THEN 'good' ELSE 'excellent' END AS quality FROM a""",
)
def fixed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = regression_metrics(guessed_prices(spark, sf_dir), "y", "p")
    metrics = metrics.withColumn("quality", quality_band(F.col("r2_amount")))
    exact = ["mae_log", "mse_log", "rmse_log", "r2_log", "r2_amount", "mape", "within_20_pct", "within_30_pct"]
    return rounded(rounded(rounded(metrics, 6, *exact), 2, "mae_amount", "rmse_amount"), 0, "mse_amount")


@query(
    "q_prediction_summary",
    f"""{GUESS_SQL}, c AS (SELECT greatest(w, 100000.0::DOUBLE) AS w FROM a) SELECT count(*) AS n, round(min(w), 2) AS "min",
    round(max(w), 2) AS "max", round(avg(w), 2) AS mean, round(median(w), 2) AS median FROM c""",
)
def predicted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = to_amounts(guessed_prices(spark, sf_dir), "p", lowest=100_000.0)
    return rounded(value_summary(amounts, "p"), 2, "min", "max", "mean", "median")


@query(
    "q_sample_predictions",
    f"""{GUESS_SQL} SELECT row_id, round(v, 4) AS actual, round(w, 4) AS predicted, round((w - v) / v * 100, 6) AS error_pct
    FROM a ORDER BY row_id LIMIT 5""",
)
def first_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = sample_predictions(guessed_prices(spark, sf_dir), "y", "p", "row_id")
    return rounded(rounded(sample, 4, "actual", "predicted"), 6, "error_pct")


# Seniority labels


def _any_sql(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


LEVEL_WORDS = dict(v.LEVEL_KEYWORDS)
LEVELS_SQL = f"""WITH {RESUMES_SQL}, y AS (SELECT *, lower(title) AS ti,
  coalesce(TRY_CAST(regexp_extract(experience, '([0-9]+)\\s*лет', 1) AS BIGINT), 0)
  + coalesce(TRY_CAST(regexp_extract(experience, '([0-9]+)\\s*месяц', 1) AS BIGINT), 0) / 12 AS years FROM resumes),
levels AS (SELECT row_id, {_any_sql('ti', v.IT_KEYWORDS)} AS in_scope, CASE WHEN {_any_sql('ti', LEVEL_WORDS['senior'])} THEN 'senior'
  WHEN {_any_sql('ti', LEVEL_WORDS['middle'])} THEN 'middle' WHEN {_any_sql('ti', LEVEL_WORDS['junior'])} THEN 'junior'
  WHEN years < 2 THEN 'junior' WHEN years < 5 THEN 'middle' ELSE 'senior' END AS level FROM y),
kept AS (SELECT * FROM levels WHERE in_scope OR (SELECT count(*) FROM levels WHERE in_scope) < 100)"""


@query("q_level_labels", f"{LEVELS_SQL} SELECT row_id, level, in_scope FROM levels")
def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_labels(resumes(spark, sf_dir), "row_id")


@query(
    "q_level_distribution",
    f"""{LEVELS_SQL} SELECT level AS "class", count(*) AS rows, round(count(*) / (SELECT count(*) FROM kept) * 100, 6) AS percent
    FROM kept GROUP BY level""",
)
def level_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_labelled(level_labels(resumes(spark, sf_dir), "row_id"), LEVEL_RULES)
    return rounded(class_distribution(kept, "level"), 6, "percent")


HITS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER ({_any_sql('ti', words)}) AS rows FROM y"
    for name, words in [*v.LEVEL_KEYWORDS, ("in scope", v.IT_KEYWORDS)]
)


@query("q_keyword_hits", f"{LEVELS_SQL} {HITS_SQL}")
def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_hits(resumes(spark, sf_dir), LEVEL_RULES)


@query(
    "q_class_set",
    f"""{LEVELS_SQL} SELECT row_id, o_totalprice AS price, level,
    CASE level WHEN 'junior' THEN 0 WHEN 'middle' THEN 1 ELSE 2 END AS level_code FROM kept JOIN orders ON row_id = o_orderkey""",
)
def class_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("price")
    )
    return classification_set(features, resumes(spark, sf_dir), "row_id")


@query(
    "q_class_weights",
    """SELECT quality AS "class", count(*) AS rows, round((SELECT count(*) FROM labels) /
    ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY quality""",
)
def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_weights(table(spark, sf_dir, "labels"), "quality"), 6, "weight")


# Class metrics of a fixed rule: the level by title and experience against one by key


def ruled_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row_id")
    guess = F.when(k % 4 == 0, "senior").when(k % 4 == 1, "junior").otherwise(F.col("level"))
    return level_labels(resumes(spark, sf_dir), "row_id").withColumn("guess", guess)


RULED_SQL = f"""{LEVELS_SQL}, r AS (SELECT level, CASE row_id % 4 WHEN 0 THEN 'senior' WHEN 1 THEN 'junior' ELSE level END AS guess
  FROM levels), s AS (SELECT level AS c, count(*) AS support, count(*) FILTER (level = guess) AS hits FROM r GROUP BY level),
g AS (SELECT guess AS c, count(*) AS claimed FROM r GROUP BY guess),
m AS (SELECT s.c, hits / claimed AS prec, hits / support AS rec, 2.0::DOUBLE * hits / (claimed + support) AS f1, support
  FROM s JOIN g ON s.c = g.c)"""


@query(
    "q_class_metrics",
    f"""{RULED_SQL} SELECT c AS "class", round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1, support FROM m""",
)
def ruled_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_metrics(ruled_levels(spark, sf_dir), "level", "guess"), 6, "precision", "recall", "f1")


@query(
    "q_class_averages",
    f"""{RULED_SQL} SELECT 'macro' AS average, round(avg(prec), 6) AS precision, round(avg(rec), 6) AS recall, round(avg(f1), 6) AS f1,
      (SELECT round(avg(CASE WHEN level = guess THEN 1 ELSE 0 END), 6) FROM r) AS accuracy, CAST(sum(support) AS BIGINT) AS support FROM m
    UNION ALL SELECT 'weighted', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), (SELECT round(avg(CASE WHEN level = guess THEN 1 ELSE 0 END), 6) FROM r),
      CAST(sum(support) AS BIGINT) FROM m""",
)
def ruled_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = averaged_metrics(class_metrics(ruled_levels(spark, sf_dir), "level", "guess"))
    return rounded(averages, 6, "precision", "recall", "f1", "accuracy")


@query(
    "q_accuracy",
    f"{RULED_SQL} SELECT round(avg(CASE WHEN level = guess THEN 1 ELSE 0 END), 6) AS accuracy FROM r",
)
def ruled_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(accuracy(ruled_levels(spark, sf_dir), "level", "guess"), 6, "accuracy")


# Classifiers


def level_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    raw = resumes(spark, sf_dir)
    extracted = advanced_features(basic_features(raw))
    flags = [v.TITLE_FLAG_PREFIX + word for word in v.TITLE_KEYWORDS]
    features = [v.AGE, v.MONTHS, v.HAS_CAR, v.TITLE_LENGTH, v.HIGHER_EDUCATION, v.TECHNICAL_EDUCATION, v.CAPITAL, *flags]
    numbers = extracted.select("row_id", *map(named, features))
    labels = level_labels(raw, "row_id")
    return align(numbers, keep_labelled(labels, LEVEL_RULES).drop("in_scope"), "row_id"), features


def _reports(spark: SparkSession, sf_dir: str, *model_types: str) -> DataFrame:
    rows, features = level_table(spark, sf_dir)
    return compare_models(train_seniority_models(rows, features, "row_id", model_types=model_types))


@query("q_logistic")
def logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir, "logistic")


@query("q_random_forest")
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir, "random_forest")


@query("q_model_compare")
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir, "logistic", "random_forest")


@query("q_quality_logistic")
def quality_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality from simple text measures."""
    text = F.col("text")
    measures = {
        "chars": F.length(text).cast("double"),
        "words": F.size(F.split(text, " ")).cast("double"),
        "digits": F.length(F.regexp_replace(text, "[^0-9]", "")).cast("double"),
        "lines": F.size(F.split(text, "\n")).cast("double"),
    }
    documents = table(spark, sf_dir, "documents").select("doc_id", *[F.log1p(m).alias(n) for n, m in measures.items()])
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    rows = align(documents, labels, "doc_id")
    return compare_models(train_seniority_models(rows, list(measures), "doc_id", "quality", ["logistic"]))


# Whole presets

RECORD = "gender_age, salary, title, city, employment, experience, education, school, trips, car"
# exact duplicates go first, then amounts are averaged over rows with equal features
RECORDS_SQL = f"""{RESUMES_SQL.replace('resumes AS', 'all_resumes AS')},
resumes AS (SELECT min(row_id) AS row_id, {RECORD} FROM all_resumes GROUP BY {RECORD})"""
SIMPLE_SQL = f"""WITH {RECORDS_SQL}, {amount_sql()}, {TYPED_SQL}, {treated_sql('500000')}
SELECT min(row_id) AS row_id, CAST(age AS DOUBLE) AS age, CAST(months AS DOUBLE) AS months, CAST(has_car AS DOUBLE) AS has_car,
  round(avg(amount), 6) AS amount
FROM treated GROUP BY gender_age, title, city, employment, experience, education, school, trips, has_car, age, months"""


@query("q_preset_simple", SIMPLE_SQL)
def preset_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare(resumes(spark, sf_dir), simple(), "row_id")
    numbers = {v.AGE: "age", v.MONTHS: "months", v.HAS_CAR: "has_car"}
    return prepared.table.select(
        "row_id", *[named(c).alias(name) for c, name in numbers.items()], F.round(named(v.SALARY_NUMBER), 6).alias("amount")
    )


REPORT_SQL = f"WITH {RECORDS_SQL}, {amount_sql()}, {TYPED_SQL}, {treated_sql('500000')}"


@query(
    "q_job_reduction",
    f"""{REPORT_SQL}, g AS (SELECT count(*) AS n FROM treated GROUP BY gender_age, title, city, employment, experience, education, school, trips, has_car, age, months)
    SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS rows_saved, round(avg(n), 6) AS mean_group_size FROM g""",
)
def job_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the preparation job reports on merged rows."""
    return rounded(prepare(resumes(spark, sf_dir), simple(), "row_id").reports["reduction"](), 6, "mean_group_size")


def _summary_sql(stage: str, x: str, source: str) -> str:
    return f"SELECT '{stage}' AS stage, count({x}) AS n, round(min({x}), 6) AS min, round(max({x}), 6) AS max, round(avg({x}), 4) AS mean, round(median({x}), 6) AS median FROM {source}"


@query("q_job_amounts", f"{REPORT_SQL} {_summary_sql('before', 'base', 'typed WHERE base > 0')} UNION ALL {_summary_sql('after', 'amount', 'treated')}")
def job_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the preparation job reports on amounts, before and after their treatment."""
    report = prepare(resumes(spark, sf_dir), simple(), "row_id").reports["amounts"]()
    return rounded(rounded(report, 6, "min", "max", "median"), 4, "mean")


@query("q_preset_improved")
def preset_improved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(resumes(spark, sf_dir), improved(), "row_id").table


@query("q_preset_improved_published")
def preset_improved_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(resumes(spark, sf_dir), improved(published=True), "row_id").table


@query("q_salary_model")
def salary_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_salary_model(prepare(resumes(spark, sf_dir), improved(), "row_id")).metrics

FEATURE_KEYS = "gender_age, title, city, employment, experience, education, school, trips, has_car, age, months, gender"


def _finished_sql(column: str) -> str:
    """Scalar subqueries around a column of ``wide``: limited to 3 interquartile ranges, then standardised."""
    low = f"(SELECT quantile_cont({column}, 0.25) - 3 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) FROM wide)"
    high = f"(SELECT quantile_cont({column}, 0.75) + 3 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) FROM wide)"
    return f"SELECT row_id, least(greatest({column}, {low}), {high}) AS x FROM wide"


IMPROVED_SQL = f"""WITH {RECORDS_SQL}, {amount_sql()}, {TYPED_SQL}, {treated_sql('1000000')},
merged AS (SELECT min(row_id) AS row_id, {FEATURE_KEYS}, avg(amount) AS amount FROM treated GROUP BY {FEATURE_KEYS}),
filled AS (SELECT row_id, gender, age::DOUBLE AS age, amount,
  coalesce(city, (SELECT city FROM merged WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1)) AS city,
  coalesce(experience, (SELECT experience FROM merged WHERE experience IS NOT NULL GROUP BY experience
    ORDER BY count(*) DESC, experience LIMIT 1)) AS experience FROM merged),
means AS (SELECT experience, avg(amount) AS experience_mean FROM filled GROUP BY experience),
wide AS (SELECT f.*, experience_mean FROM filled f JOIN means m ON f.experience = m.experience),
ages AS ({_finished_sql('age')}), terms AS ({_finished_sql('experience_mean')})
SELECT wide.row_id, CAST(gender = 'Мужчина' AS DOUBLE) AS male, CAST(city = 'Минск' AS DOUBLE) AS minsk, round(amount, 5) AS amount,
  round((ages.x - (SELECT avg(x) FROM ages)) / (SELECT stddev_pop(x) FROM ages), 5) AS age,
  round((terms.x - (SELECT avg(x) FROM terms)) / (SELECT stddev_pop(x) FROM terms), 5) AS experience
FROM wide JOIN ages ON wide.row_id = ages.row_id JOIN terms ON wide.row_id = terms.row_id"""


@query("q_preset_improved_core", IMPROVED_SQL)
def preset_improved_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the improved preset that went through every kind of step."""
    table = prepare(resumes(spark, sf_dir), improved(), "row_id").table
    core = table.select(
        "row_id",
        named(f"{v.GENDER}_Мужчина").alias("male"),
        named(f"{v.CITY}_Минск").alias("minsk"),
        named(v.SALARY_NUMBER).alias("amount"),
        named(v.AGE).alias("age"),
        named(v.EXPERIENCE).alias("experience"),
    )
    return rounded(core, 5, "amount", "age", "experience")
