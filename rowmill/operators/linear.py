"""Regularised linear regression with cross-validation from one pass over the rows.

All that ridge, lasso and elastic net need from the data are sums of products per fold. Spark adds them
up in a single ``groupBy(fold)``; every penalty and every train/held-out combination then follows from
matrices as small as the feature list. The chosen model is fitted as a native ML pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.functions.text import named
from rowmill.operators.correlation import select_features
from rowmill.operators.evaluate import to_amounts
from rowmill.operators.moments import column_stats, grouped_products
from rowmill.operators.scale import Scaling
from rowmill.operators.split import row_hash

# Penalty grid and defaults of the published models.
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
FOLDS = 5
PATH_LENGTH = 100
PATH_RATIO = 1e-3
L1_SHARE = {"ridge": 0.0, "lasso": 1.0, "elasticnet": 0.5}


@dataclass(frozen=True)
class Sums:
    """Row count, sums and product sums of the features with the target as last column."""

    n: float
    s: np.ndarray
    p: np.ndarray

    @staticmethod
    def of(products: np.ndarray) -> Sums:
        """From the product sums of (1, features, target)."""
        return Sums(float(products[0, 0]), products[0, 1:], products[1:, 1:])

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.s + other.s, self.p + other.p)

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.n - other.n, self.s - other.s, self.p - other.p)

    def covariance(self) -> np.ndarray:
        mean = self.s / self.n
        return self.p / self.n - np.outer(mean, mean)

    def intercept(self, w: np.ndarray) -> float:
        return float((self.s[-1] - w @ self.s[:-1]) / self.n)

    def squared_error(self, w: np.ndarray, intercept: float) -> float:
        v = np.append(-w, 1.0)
        return float(v @ self.p @ v - 2 * intercept * (v @ self.s) + self.n * intercept**2)

    def r2(self, w: np.ndarray, intercept: float) -> float:
        total = self.p[-1, -1] - self.s[-1] ** 2 / self.n
        return 1.0 - self.squared_error(w, intercept) / total


def ridge_weights(train: Sums, alpha: float) -> np.ndarray:
    cov = train.covariance() * train.n
    return np.linalg.solve(cov[:-1, :-1] + alpha * np.eye(len(cov) - 1), cov[:-1, -1])


def penalty_path(train: Sums, l1_share: float) -> np.ndarray:
    """Geometric grid from the smallest penalty that zeroes all weights down to a thousandth of it."""
    top = np.abs(train.covariance()[:-1, -1]).max() / l1_share
    return np.geomspace(top, top * PATH_RATIO, PATH_LENGTH) if top > 0 else np.full(PATH_LENGTH, 1e-12)


def elastic_net_weights(trains: Sequence[Sums], paths: np.ndarray, l1_share: float, rounds: int = 1000) -> np.ndarray:
    """Weights per training set and penalty.

    Coordinate descent on the covariances finds which weights are zero and the signs of the others; those
    given, the weights solve a linear system, and the optimality conditions tell whether the guess was
    right. All training sets move as one batch; each penalty starts from the weights of the one before.
    """
    cov = np.stack([t.covariance() for t in trains])
    gram, pull = cov[:, :-1, :-1], cov[:, :-1, -1]
    w = np.zeros_like(pull)
    found = np.empty((paths.shape[1], *w.shape))
    for at in range(paths.shape[1]):
        l1, l2 = paths[:, at, None] * l1_share, paths[:, at, None] * (1 - l1_share)
        for _ in range(rounds):
            exact, solved = _solve_for_signs(gram, pull, w, l1, l2)
            w = np.where(solved[:, None], exact, w)
            if solved.all():
                break
            _descend(gram, pull, w, l1[:, 0], l2[:, 0], sweeps=5)
        found[at] = w
    return found.transpose(1, 0, 2)


def _solve_for_signs(gram, pull, w, l1, l2):
    """Weights that are optimal if the signs of ``w`` are, and whether they are, per training set."""
    signs = np.sign(w)
    active = signs != 0
    eye = np.eye(w.shape[1])
    tiny = 1e-13 * np.trace(gram, axis1=1, axis2=2)[:, None]
    inner = np.where(active[:, :, None] & active[:, None, :], gram, 0.0)
    system = inner + eye * np.where(active, l2 + tiny, 1.0)[:, :, None]
    exact = np.linalg.solve(system, np.where(active, pull - l1 * signs, 0.0)[..., None])[..., 0]
    slope = pull - np.einsum("mij,mj->mi", gram, exact) - l2 * exact
    fits = np.where(active, np.sign(exact) == signs, np.abs(slope) <= l1 * (1 + 1e-9) + 1e-14)
    return exact, fits.all(axis=1)


def _descend(gram, pull, w, l1, l2, sweeps: int) -> None:
    for _ in range(sweeps):
        for j in range(w.shape[1]):
            diagonal = gram[:, j, j]
            free = pull[:, j] - np.einsum("mk,mk->m", gram[:, j], w) + diagonal * w[:, j]
            shrunk = np.sign(free) * np.maximum(np.abs(free) - l1, 0.0)
            w[:, j] = np.divide(shrunk, diagonal + l2, out=np.zeros_like(shrunk), where=diagonal + l2 > 0)


def choose_penalty(cells: Sequence[Sums], model_type: str) -> tuple[float, np.ndarray]:
    """Penalty with the best mean score over the cells held out in turn, and its weights on all rows.

    Ridge is scored by R², lasso and elastic net by squared error.
    """
    cells = [c for c in cells if c.n > 0]
    total = _total(cells)
    if model_type == "ridge":
        scores = []
        for alpha in RIDGE_ALPHAS:
            fits = [(c, total - c, ridge_weights(total - c, alpha)) for c in cells]
            scores.append(np.mean([c.r2(w, rest.intercept(w)) for c, rest, w in fits]))
        best = RIDGE_ALPHAS[int(np.argmax(scores))]
        return best, ridge_weights(total, best)
    share = L1_SHARE[model_type]
    path = penalty_path(total, share)
    rests = [total - c for c in cells]
    weights = elastic_net_weights([*rests, total], np.tile(path, (len(cells) + 1, 1)), share)
    errors = [
        [c.squared_error(w, rest.intercept(w)) / c.n for w in per_path] for c, rest, per_path in zip(cells, rests, weights)
    ]
    at = int(np.argmin(np.mean(errors, axis=0)))
    return float(path[at]), weights[-1, at]


def _total(cells: Sequence[Sums]) -> Sums:
    total = cells[0]
    for cell in cells[1:]:
        total = total + cell
    return total


def _rescaled(sums: Sums, mean: np.ndarray, std: np.ndarray) -> Sums:
    """The sums as they would be for (x − mean) / std; the target stays."""
    mean, std = np.append(mean, 0.0), np.append(std, 1.0)
    cross = np.outer(mean, sums.s)
    p = sums.p - cross - cross.T + sums.n * np.outer(mean, mean)
    return Sums(sums.n, (sums.s - sums.n * mean) / std, p / np.outer(std, std))


def nested_scores(grid: dict[tuple[int, int], Sums], model_type: str) -> list[float]:
    """R² per outer fold of the whole procedure: scaling and penalty are found anew without the fold."""
    scores = []
    for fold in sorted({outer for outer, _ in grid}):
        held_out = _total([s for (outer, _), s in grid.items() if outer == fold])
        inner: dict[int, Sums] = {}
        for (outer, part), sums in grid.items():
            if outer != fold:
                inner[part] = inner[part] + sums if part in inner else sums
        if not inner:
            continue
        train = _total(list(inner.values()))
        mean, var = train.s[:-1] / train.n, np.diag(train.covariance())[:-1]
        std = np.where(var > 1e-15, np.sqrt(np.maximum(var, 0.0)), 1.0)
        cells = [_rescaled(s, mean, std) for s in inner.values()]
        _, w = choose_penalty(cells, model_type)
        scores.append(float(_rescaled(held_out, mean, std).r2(w, _total(cells).intercept(w))))
    return scores


@dataclass(frozen=True)
class LinearFit:
    """A trained regression with everything a report needs."""

    model: PipelineModel
    model_type: str
    features: list[str]
    all_features: list[str]
    alpha: float
    l1_ratio: float | None
    coefficients: list[float]
    cv_scores: list[float]
    metrics: dict[str, float] = field(default_factory=dict)

    @property
    def cv_mean(self) -> float:
        return float(np.mean(self.cv_scores))

    @property
    def cv_std(self) -> float:
        return float(np.std(self.cv_scores))


def scaling_stage(features: Sequence[str], scaling: Scaling) -> SQLTransformer:
    """Scaling as a stage that is saved with the pipeline and runs as plain expressions."""
    scaled = []
    for i, name in enumerate(features):
        centre, spread = scaling[name]
        quoted = "`" + name.replace("`", "``") + "`"
        scaled.append(f"(CAST({quoted} AS DOUBLE) - ({float(centre)!r}D)) / ({float(spread)!r}D) AS _z{i}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def helper_columns(features: Sequence[str]) -> list[str]:
    return [*[f"_z{i}" for i in range(len(features))], "_features"]


def train_linear(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    row_id: str,
    model_type: str = "ridge",
    n_features: int = 15,
    folds: int = FOLDS,
) -> LinearFit:
    """Select, scale, cross-validate and fit: a handful of passes over the training rows whatever the grid."""
    if model_type not in L1_SHARE:
        raise ValueError(f"unsupported model type: {model_type}")
    chosen = select_features(df, features, target, n_features)
    stats = column_stats(df, [*chosen, target])
    scaling = {name: (stats[name]["mean"], stats[name]["std"] or 1.0) for name in chosen}
    z = [(named(name).cast("double") - F.lit(c)) / F.lit(s) for name, (c, s) in scaling.items()]
    z.append(named(target).cast("double") - F.lit(stats[target]["mean"]))
    outer, inner = (row_hash(named(row_id), salt) % folds for salt in ("fold:", "inner fold:"))
    cells = grouped_products(df, z, outer * folds + inner)
    grid = {divmod(cell, folds): Sums.of(products) for cell, products in cells.items()}
    by_fold: dict[int, Sums] = {}
    for (outer, _), sums in grid.items():
        by_fold[outer] = by_fold[outer] + sums if outer in by_fold else sums
    alpha, _ = choose_penalty(list(by_fold.values()), model_type)

    reg_param, l1_part = spark_penalty(model_type, alpha, stats[target]["std"], stats[target]["n"])
    stages = [
        scaling_stage(chosen, scaling),
        VectorAssembler(inputCols=[f"_z{i}" for i in range(len(chosen))], outputCol="_features"),
        LinearRegression(
            featuresCol="_features",
            labelCol=target,
            predictionCol="prediction",
            regParam=reg_param,
            elasticNetParam=l1_part,
            standardization=False,
            solver="normal",
            maxIter=5000,
            tol=1e-13,
        ),
    ]
    model = Pipeline(stages=stages).fit(df)
    return LinearFit(
        model=model,
        model_type=model_type,
        features=chosen,
        all_features=list(features),
        alpha=alpha,
        l1_ratio=L1_SHARE[model_type] if model_type == "elasticnet" else None,
        coefficients=[float(c) for c in model.stages[-1].coefficients],
        cv_scores=nested_scores(grid, model_type),
    )


def spark_penalty(model_type: str, alpha: float, target_std: float, rows: int) -> tuple[float, float]:
    """(regParam, elasticNetParam) that give Spark's objective the same minimum.

    Spark divides the squared-weight part by the target's deviation, but not the absolute-weight part;
    ridge penalties are stated per data set, the others per row.
    """
    if model_type == "ridge":
        return alpha * target_std / rows, 0.0
    l1 = alpha * L1_SHARE[model_type]
    total = l1 + alpha * (1 - L1_SHARE[model_type]) * target_std
    return total, l1 / total


def predict(
    df: DataFrame, model: PipelineModel, features: Sequence[str], as_log: bool = False, lowest: float = 10_000.0
) -> DataFrame:
    """Add ``prediction``: an amount of at least ``lowest``, or the log value."""
    scored = model.transform(df).drop(*helper_columns(features))
    return scored if as_log else to_amounts(scored, "prediction", lowest)


def coefficient_table(spark: SparkSession, names: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Coefficients ranked by size, with the direction of their effect."""
    if len(names) != len(coefficients):
        names = [f"feature_{i}" for i in range(len(coefficients))]
    rows = [(name, float(value)) for name, value in zip(names, coefficients)]
    return rank_coefficients(spark.createDataFrame(rows, "feature string, coefficient double"))


def rank_coefficients(table: DataFrame) -> DataFrame:
    by_size = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("coefficient")), "feature")  # one row per feature
    return table.select(
        "feature",
        "coefficient",
        F.abs("coefficient").alias("abs_coefficient"),
        F.row_number().over(by_size).alias("importance_rank"),
        F.when(F.col("coefficient") > 0, "increases").otherwise("decreases").alias("impact"),
    )


def cv_summary(spark: SparkSession, fit: LinearFit) -> DataFrame:
    """``(fold, r2)`` rows folded into mean and population deviation."""
    scores = spark.createDataFrame([(i, s) for i, s in enumerate(fit.cv_scores)], "fold int, r2 double")
    return scores.agg(F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
