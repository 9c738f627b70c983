import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowmill.operators.categorical import Encoder, apply_target_means, fit_encoder, profile_categories
from rowmill.operators.columns import (
    append_columns,
    coerce_numeric,
    first_present,
    numeric_columns,
    project_features,
    reconcile_names,
    split_target,
    text_columns,
    unique,
)
from rowmill.operators import moments
from rowmill.operators.correlation import collinear_columns, collinear_from_pairs, fit_collinear, pair_correlations, strongest, target_correlations
from rowmill.operators.dedupe import drop_duplicate_rows, merge_duplicate_features
from rowmill.operators.impute import fill_missing, fit_medians, fit_modes, modes, prepare_features
from rowmill.operators.joins import map_values
from rowmill.operators.moments import column_stats, pair_moments
from rowmill.operators.outliers import fit_bounds, limit_to_bounds, remove_outlier_rows, treat_outliers
from rowmill.operators.quantiles import exact_quantiles
from rowmill.operators.scale import fit_normalizer, normalize
from rowmill.operators.split import with_stratified_test_flag, with_test_flag
from rowmill.operators.summary import corrected_skewness, quality_report
from rowmill.operators.target import fit_amount_treatment, prepare_target


@pytest.fixture(scope="module")
def mixed(spark):
    """2,000 rows: correlated numbers with gaps, a constant, and a value that holds a third of all rows."""
    rng = np.random.default_rng(3)
    a = rng.normal(1000, 5, 2000)
    frame = pd.DataFrame(
        {
            "row_id": np.arange(2000),
            "a": a,
            "b": a * 3 + rng.normal(0, 1, 2000),
            "c": rng.exponential(1, 2000),
            "hot": np.where(np.arange(2000) % 3 == 0, 7.0, rng.normal(7, 2, 2000)),
            "constant": 4.0,
        }
    )
    frame.loc[frame.row_id % 7 == 0, "b"] = np.nan
    frame.loc[frame.row_id % 5 == 0, "c"] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "row_id long, a double, b double, c double, hot double, constant double")
    return df.repartition(5), frame


MEASURES = ["a", "b", "c", "hot", "constant"]


@pytest.mark.parametrize("few_values", [100_000, 40, 3])
def test_quantiles_are_exact(mixed, few_values):
    df, frame = mixed
    at = [0.0, 0.05, 0.25, 1 / 3, 0.5, 0.95, 1.0]
    found = exact_quantiles(df, MEASURES, at, few_values)
    for name in MEASURES:
        assert found[name] == pytest.approx(list(frame[name].quantile(at)), rel=1e-12), name


@pytest.mark.parametrize("few_values", [100_000, 10])
def test_quantiles_between_hot_neighbours(spark, few_values):
    x = spark.range(9000).selectExpr(
        "case id % 3 when 0 then 10.0D when 1 then 20.0D else 10 + (id % 500) / 50.5D end as x"
    )
    at = [0.1, 1 / 3, 0.34, 0.5, 0.66, 0.67, 0.9]
    expected = np.quantile(x.toPandas()["x"], at)
    assert exact_quantiles(x, ["x"], at, few_values)["x"] == pytest.approx(list(expected), rel=1e-12)


def test_quantiles_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [2.0], "y": [None]}
    assert exact_quantiles(df, [], [0.5]) == {}
    six = spark.range(1, 7).select(F.col("id").alias("x"))
    assert exact_quantiles(six, ["x"], [0.25])["x"] == [2.25]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "i int, d double, s string, b boolean")
    assert numeric_columns(df) == ["i", "d"] and text_columns(df) == ["s"]
    assert numeric_columns(df, exclude=["i"]) == ["d"]
    assert unique(["b", "a", "b"]) == ["b", "a"]
    assert first_present(df, ["no", "s", "i"]) == "s" and first_present(df, ["no"]) is None
    assert split_target(df, "d", ["i"]) == (["s", "b"], "d")
    with pytest.raises(ValueError):
        split_target(df, "missing")
    assert project_features(df, ["d", "i"]).columns == ["d", "i"]
    assert project_features(df.select("d", "i"), ["d", "i"]).columns == ["d", "i"]
    with pytest.raises(ValueError):
        project_features(df, ["missing"])
    with pytest.raises(ValueError):
        append_columns(df, {"i": F.lit(1)})
    assert append_columns(df, {"n": F.lit(1)}).columns == ["i", "d", "s", "b", "n"]


def test_reconcile_names():
    assert reconcile_names(["a", "b", "c"], 2) == ["a", "b"]
    assert reconcile_names(["a"], 3) == ["a", "feature_1", "feature_2"]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("-.5",), ("1e3",), ("x",), ("nan",), ("2-3",), ("",), (None,)], "s string")
    assert [r["s"] for r in coerce_numeric(df).collect()] == [1.5, 2.0, -0.5, 1000.0, None, None, None, None, None]


def test_dedupe(spark):
    rows = [(1, "a", None), (2, "a", None), (3, "a", "x"), (4, None, None), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, s string, t string")
    assert sorted(r["id"] for r in drop_duplicate_rows(df, "id").collect()) == [1, 3, 4]
    once = drop_duplicate_rows(df.drop("id"))
    assert once.count() == 3 and drop_duplicate_rows(once).count() == 3


def test_merge_duplicate_features(spark):
    rows = [(1, "a", None, 2.0), (2, "a", None, 4.0), (3, "b", 1, 10.0), (4, "b", 1, 20.0), (5, "b", 2, 5.0)]
    df = spark.createDataFrame(rows, "id int, s string, k int, y double")
    merged = merge_duplicate_features(df, "y", row_id="id", size_column="n").collect()
    assert sorted((r["id"], r["y"], r["n"]) for r in merged) == [(1, 3.0, 2), (3, 15.0, 2), (5, 5.0, 1)]
    kept = merge_duplicate_features(df, "y", row_id="id", drop_null_keys=True).collect()
    assert sorted(r["id"] for r in kept) == [3, 5]
    by_s = merge_duplicate_features(df, "y", keys=["s"], sort=True).collect()
    assert [(r["s"], r["y"]) for r in by_s] == [("a", 3.0), ("b", pytest.approx(35 / 3))]


def test_impute(spark):
    rows = [(1, 1.0, "b"), (2, None, "a"), (None, 4.0, "a"), (4, float("nan"), "b"), (9, 5.0, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string").withColumn("empty", F.lit(None).cast("string"))
    fills = {**fit_medians(df), **fit_modes(df, "none")}
    assert fills == {"i": 3.0, "d": 4.0, "s": "a", "empty": "none"}
    filled = fill_missing(df, fills).collect()
    assert [(r["i"], r["d"], r["s"], r["empty"]) for r in filled] == [
        (1.0, 1.0, "b", "none"), (2.0, 4.0, "a", "none"), (3.0, 4.0, "a", "none"), (4.0, 4.0, "b", "none"), (9.0, 5.0, "a", "none"),
    ]
    mode = spark.createDataFrame([(x,) for x in "31139"], "x string")
    assert fit_modes(mode, "none") == {"x": "1"}
    text = spark.createDataFrame([("1",), ("x",), ("4",), (None,)], "x string")
    assert [r["x"] for r in prepare_features(text, ["x"]).collect()] == [1.0, 2.5, 4.0, 2.5]


def encoder_rows(spark):
    rows = []
    for i in range(60):
        rows.append(
            (
                i,
                "no" if i % 2 == 0 else "yes",
                None if i % 10 == 0 else ("p" if i % 2 else "q"),
                ["red", "green", "blue"][i % 3],
                f"town {i % 12}" if i % 5 else None,
                f"id {i}",
                "same",
                float(i),
            )
        )
    names = "row_id int, two string, two_gap string, colour string, town string, key string, single string, y double"
    return spark.createDataFrame(rows, names), pd.DataFrame(rows, columns=[n.split()[0] for n in names.split(", ")])


def test_encoder(spark):
    df, frame = encoder_rows(spark)
    encoder = fit_encoder(df, "y", ["row_id"], max_distinct=20, max_one_hot=5)
    assert encoder.dropped == ["key"]
    assert encoder.binary == {"two": ("no", "yes")}
    assert encoder.one_hot == {"colour": ["blue", "green", "red"]}
    assert encoder.by_target == ["two_gap", "town", "single"]  # nulls rule out binary coding
    out = encoder.apply(df)
    assert out.columns == ["row_id", "two", "two_gap", "town", "single", "colour_green", "colour_red", "y"]
    rows = {r["row_id"]: r for r in out.collect()}
    means = frame.groupby("town").y.mean()
    for i in range(60):
        town = frame.town[i]
        assert rows[i]["town"] == pytest.approx(means[town] if town else frame.y.mean())
        assert rows[i]["two"] == float(i % 2)
        assert (rows[i]["colour_green"], rows[i]["colour_red"]) == (i % 3 == 1, i % 3 == 0)
        assert rows[i]["single"] == pytest.approx(frame.y.mean())
    # weighted by counts, encoded values average to the global mean
    no_gaps = out.filter("town is not null").agg(F.avg("single")).first()[0]
    assert no_gaps == pytest.approx(frame.y.mean())
    # unseen categories
    unseen = encoder.apply(df.limit(1).withColumns({"two": F.lit("maybe"), "colour": F.lit("pink"), "town": F.lit("nowhere")}))
    row = unseen.first()
    assert row["two"] is None and not row["colour_red"] and row["town"] == pytest.approx(frame.y.mean())


def test_encoder_without_target_or_text(spark):
    df, _ = encoder_rows(spark)
    out = fit_encoder(df.drop("y"), order_by=["row_id"], max_distinct=20, max_one_hot=5).apply(df.drop("y"))
    assert dict(out.dtypes)["town"] == "string"
    assert fit_encoder(df.select("row_id")).apply(df.select("row_id")).columns == ["row_id"]
    assert isinstance(fit_encoder(df.select("row_id")), Encoder)


def test_lookup_beyond_broadcast_size_gives_the_same(spark):
    df, _ = encoder_rows(spark)
    df = df.select("row_id", "town", "y")
    profile = profile_categories(df, ["town"], "y")
    small = apply_target_means(df, "town", profile)
    large = map_values(df, "town", profile.lookup("town"), F.lit(profile.global_mean), 12, broadcast_bytes=1)
    assert "_copy" in large._jdf.queryExecution().analyzed().toString()
    assert "_copy" not in small._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_correlations_match_pandas(mixed):
    df, frame = mixed
    expected = frame[MEASURES].corr().to_numpy()
    found = pair_moments(df, MEASURES).correlations()
    assert np.allclose(found[:4, :4], expected[:4, :4], atol=1e-9)
    assert np.isnan(found[4]).all() and np.isnan(found[:, 4]).all()


def test_column_stats_do_not_depend_on_width(mixed):
    df, frame = mixed
    many = MEASURES + [f"a{i}" for i in range(8)]
    wide = df.withColumns({f"a{i}": F.col("a") * (i + 1) for i in range(8)})
    for name, s in column_stats(wide, many).items():
        narrow = column_stats(wide, [name])[name]
        assert (s["rows"], s["n"]) == (narrow["rows"], narrow["n"])
        assert s["mean"] == pytest.approx(narrow["mean"], rel=1e-12) and s["std"] == pytest.approx(narrow["std"], abs=1e-9)


@pytest.mark.parametrize("width", [1, 12])
def test_moments_of_late_large_values(spark, width):
    """First rows null, then values near 1.7e12; a constant; an infinity."""
    x = F.when(F.col("id") >= 2000, 1.7e12 + F.col("id") % 100)
    df = spark.range(4000).repartition(5).select(*[(x + i).alias(f"x{i}") for i in range(width)], (x * 2).alias("y"), F.lit(0.1).alias("c"))
    df = df.withColumn("inf", F.when(F.col("y").isNotNull(), F.lit(float("inf"))))
    stats = column_stats(df, df.columns)
    assert stats["x0"]["n"] == 2000 and stats["x0"]["std"] == pytest.approx(np.std(np.arange(100)), rel=1e-6)
    assert stats["c"] == {"rows": 4000, "n": 4000, "mean": 0.1, "std": 0.0} and np.isnan(stats["inf"]["std"])
    got = {r["feature"]: r["correlation"] for r in target_correlations(df, ["x0", "c", "inf"], "y").collect()}
    assert got == {"x0": pytest.approx(1.0, abs=1e-9)}
    assert pair_moments(df, ["x0", "y", "inf"]).correlations()[0, 1] == pytest.approx(1.0, abs=1e-9)


def test_target_correlations(mixed):
    df, frame = mixed
    rows = target_correlations(df, ["b", "c", "hot", "constant"], "a")
    assert {r["feature"] for r in rows.collect()} == {"b", "c", "hot"}  # the constant is skipped
    for r in rows.collect():
        assert r["correlation"] == pytest.approx(frame[r["feature"]].corr(frame["a"]), abs=1e-9)
    tied = df.select("a", F.col("a").alias("x"), (-F.col("a")).alias("y"))
    top = strongest(target_correlations(tied, ["x", "y"], "a"), 2).collect()
    assert [(r["feature"], r["direction"]) for r in sorted(top, key=lambda r: (-round(r["abs_correlation"], 9), -r["position"]))] == [
        ("y", "down"), ("x", "up"),
    ]


def _walk(matrix, threshold):
    """The rule spelled out pair by pair."""
    strength, gone = pd.DataFrame(np.abs(matrix)), set()
    mean = strength.mean()
    k = len(strength)
    for i in range(k):
        for j in range(i + 1, k):
            if strength.iloc[i, j] > threshold:
                if mean[i] > mean[j]:
                    gone.add(i)
                    break
                gone.add(j)
    return gone


def test_collinear_columns():
    rng = np.random.default_rng(0)
    for _ in range(200):
        k = rng.integers(2, 7)
        m = np.corrcoef(rng.normal(size=(4, k)), rowvar=False).reshape(k, k)
        names = [f"c{i}" for i in range(k)]
        assert set(collinear_columns(names, m, 0.6)) == {f"c{i}" for i in _walk(m, 0.6)}
    with_nan = np.array([[1, 0.99, np.nan], [0.99, 1, np.nan], [np.nan, np.nan, np.nan]])
    assert collinear_columns(["a", "b", "c"], with_nan, 0.9) == ["b"]


def test_modes_of_all_kinds_of_columns(spark):
    k = F.col("id")
    df = spark.range(40_000).select(
        F.when(k % 40 == 0, "hot").otherwise(F.concat(F.lit("u"), k.cast("string"))).alias("one stands out"),
        k.cast("string").alias("all.unique"),
        F.lit(None).cast("string").alias("empty"),
        F.when(k % 3 != 0, (k % 3).cast("string")).alias("tie"),
        F.concat(F.lit("v"), (k % 15_000).cast("string")).alias("none stands out"),
    )
    assert modes(df, df.columns, "none") == {"one stands out": "hot", "all.unique": "0", "empty": "none", "tie": "1", "none stands out": "v0"}
    assert modes(df.limit(0), df.columns, "none") == dict.fromkeys(df.columns, "none")


@pytest.mark.parametrize("seed", range(6))
def test_amount_treatment_equals_numpy(spark, seed):
    draw = np.random.default_rng(seed)
    x = np.round(draw.lognormal(3, 1, 1 + 60 * seed), draw.integers(0, 3)) * draw.choice([1, 1, 1, 0, -1], 1 + 60 * seed)
    x[draw.random(len(x)) < 0.1 * seed] *= 100
    threshold = [50.0, 1e9, 0.001][seed % 3]
    usual, over = x[(x > 0) & (x <= threshold)], x[x > threshold]
    df = spark.createDataFrame(pd.DataFrame({"a": x}))
    spark.sparkContext.setJobGroup(f"amounts {seed}", "")
    got = fit_amount_treatment(df, "a", threshold)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"amounts {seed}")) <= 5
    if not len(usual) + len(over):
        assert not got.active
        return
    cap = np.quantile(usual, 0.95) if len(usual) else None
    assert got.cap == pytest.approx(cap) if cap is not None else got.cap is None
    capped = np.concatenate([usual, over if cap is None else np.full(len(over), cap)])
    assert got.fill == pytest.approx(np.median(np.log1p(capped)))


def test_pairs_by_blocks_equal_the_matrix(spark, monkeypatch):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 11)) + draw.normal(size=(300, 1)) * np.arange(11)
    x[:, 3], x[::7, 4], x[:, 10] = 2.5, np.nan, x[:, 9] * -2 + 1e9
    names = [f"c{i}" if i != 5 else "a.b" for i in range(11)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(5)
    matrix = pair_moments(df, names).correlations()
    for block, room in ((128, 128 << 20), (4, 128 << 20), (4, 1)):  # one block; several; one pair of blocks at a time
        monkeypatch.setattr(moments, "STATE_BYTES", room)
        rows = moments.pair_table(df, names, block).collect()
        assert sorted((r.i, r.j) for r in rows) == [(i, j) for i in range(11) for j in range(i, 11)]
        for r in rows:
            want = matrix[r.i, r.j]
            assert r.correlation is None if np.isnan(want) else r.correlation == pytest.approx(want, abs=1e-9)
    monkeypatch.undo()
    for threshold in (0.5, 0.9):
        pairs = pair_correlations(df, names)
        assert collinear_from_pairs(names, pairs, threshold) == collinear_columns(names, matrix, threshold)
    empty = [r.correlation for r in moments.pair_table(df.limit(0), names[:2]).collect()]
    assert empty in ([None] * 3, [])


def test_blocks_without_missing_values_need_no_masks(spark):
    """Sums take the place of five products of six; pairs with a column that misses values, or has an infinite one, are as before."""
    draw = np.random.default_rng(6)
    x = draw.normal(size=(400, 8)) + draw.normal(size=(400, 1)) * np.arange(8) + 1e6
    x[:, 1], x[::5, 5] = 7.25, np.nan
    blocks = [moments._centred(x[:, at : at + 4]) for at in (0, 4)]
    assert blocks[0].mask is None and blocks[1].mask is not None
    assert blocks[0].sums == pytest.approx(np.zeros(4), abs=1e-6) and blocks[0].squares == pytest.approx(400 * x[:, :4].var(axis=0))
    names = [f"c{i}" for i in range(8)]
    for values in (x, np.where(np.arange(400)[:, None] % 97 == 0, np.where(np.arange(8) == 7, np.inf, x), x)):
        df = spark.createDataFrame(pd.DataFrame(values, columns=names)).repartition(3)
        for r in moments.pair_table(df, names, 4).collect():
            pair = values[:, [r.i, r.j]]
            pair = pair[~np.isnan(pair).any(axis=1)]
            assert r.n == len(pair)
            if np.isinf(pair).any() or 1 in (r.i, r.j):
                assert r.correlation is None
            else:
                assert r.correlation == pytest.approx(np.corrcoef(pair.T)[0, 1], abs=1e-9)


def test_fit_collinear(mixed):
    df, _ = mixed
    assert len(fit_collinear(df, 0.9, exclude=["row_id"])) == 1
    assert fit_collinear(df.select("a"), 0.9) == []


@pytest.mark.parametrize("detector", ["iqr", "zscore"])
def test_outliers(mixed, detector):
    df, frame = mixed
    bounds = fit_bounds(df, detector, 1.5, MEASURES)
    for name in ("a", "b", "c", "hot"):
        x = frame[name]
        if detector == "iqr":
            q1, q3 = x.quantile(0.25), x.quantile(0.75)
            low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        else:
            low, high = x.mean() - 1.5 * x.std(), x.mean() + 1.5 * x.std()
        assert bounds[name] == (pytest.approx(low), pytest.approx(high))
    limited = limit_to_bounds(df, bounds).toPandas()
    for name, (low, high) in bounds.items():
        assert limited[name].dropna().between(low, high).all()
        assert limited[name].isna().sum() == frame[name].isna().sum()
    left = remove_outlier_rows(df, bounds)
    keep = np.ones(len(frame), dtype=bool)
    for name, (low, high) in bounds.items():
        keep &= ~((frame[name] < low) | (frame[name] > high))
    assert sorted(r["row_id"] for r in left.collect()) == list(frame.row_id[keep])
    clipped = treat_outliers(df, detector, "clip", 1.5, MEASURES).toPandas()
    assert clipped.sort_values("row_id").equals(limited.sort_values("row_id")) or np.allclose(
        clipped.sort_values("row_id").fillna(0), limited.sort_values("row_id").fillna(0)
    )


def test_outlier_arguments(mixed):
    df, _ = mixed
    with pytest.raises(ValueError):
        fit_bounds(df, "median")
    with pytest.raises(ValueError):
        treat_outliers(df, action="ignore")


@pytest.mark.parametrize("robust", [True, False])
def test_normalizer(mixed, robust):
    df, frame = mixed
    df = df.withColumn("flag", F.col("row_id") % 2 == 0)
    columns, steps = fit_normalizer(df, robust=robust, standard=True, exclude=["row_id"])
    assert columns == MEASURES
    out = normalize(df, columns, steps).toPandas().sort_values("row_id")
    filled = frame.fillna(0.0)
    for name in MEASURES:
        x = filled[name]
        if robust:
            x = (x - x.median()) / ((x.quantile(0.75) - x.quantile(0.25)) or 1.0)
        expected = (x - x.mean()) / (x.std(ddof=0) or 1.0)
        assert np.allclose(out[name], expected, atol=1e-9), name
    assert out["flag"].dtype == bool


def test_amount_treatment(spark):
    values = [0.0, -5.0, 10.0, 20.0, 30.0, 5000.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    treated = [r["x"] for r in fit_amount_treatment(df, "x", 1000.0).apply(df).collect()]
    capped = np.log1p([10, 20, 30, np.quantile([10, 20, 30], 0.95)])
    assert treated == pytest.approx([np.median(capped)] * 2 + list(capped))
    assert fit_amount_treatment(df, "x", None).apply(df).collect() == df.collect()
    none = df.filter("x <= 0")
    assert fit_amount_treatment(none, "x", 1000.0).apply(none).collect() == none.collect()


def test_prepare_target(spark):
    df = spark.createDataFrame([("3",), ("-1",), ("0",), ("x",)], "y string")
    out = [r["y"] for r in prepare_target(df, "y").collect()]
    assert out[:3] == pytest.approx([np.log1p(3)] * 3) and out[3] is None
    negative = spark.createDataFrame([(-2.0,)], "y double")
    assert prepare_target(negative, "y").first()["y"] == pytest.approx(np.log1p(1.0))


def test_skewness(spark):
    df = spark.createDataFrame([(float(x),) for x in (3, 1, 1, 3, 9)], "x double")
    row = df.agg(F.skewness("x"), corrected_skewness(F.col("x"))).first()
    assert tuple(row) == (pytest.approx(1.164264, abs=1e-6), pytest.approx(1.735582, abs=1e-6))
    flat = spark.createDataFrame([(1.0,), (1.0,), (1.0,)], "x double")
    assert flat.agg(corrected_skewness(F.col("x"))).first()[0] is None


def test_quality_report(spark):
    rows = [(1.0, None, 0.1), (float("inf"), 2.0, 0.2), (float("nan"), 3.0, None), (4.0, 4.0, 0.3)]
    report = quality_report(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y").first()
    assert (report["x_missing"], report["y_missing"], report["x_infinite"], report["y_infinite"]) == (2, 1, 1, 0)
    assert report["target_unusual"] is False


def test_split_is_stable_and_complete(spark):
    ids = spark.range(2000).withColumnRenamed("id", "row_id")
    one = {r["row_id"]: r["is_test"] for r in with_test_flag(ids.repartition(1), "row_id").collect()}
    many = {r["row_id"]: r["is_test"] for r in with_test_flag(ids.repartition(13), "row_id").collect()}
    assert one == many and len(one) == 2000 and 0.15 < np.mean(list(one.values())) < 0.25


@pytest.mark.parametrize("leaf_rows", [10_000, 20])
def test_stratified_split(spark, leaf_rows):
    """Exact counts per class, with one class holding two thirds of the rows, by any search depth."""
    random.seed(1)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else random.choice("ab")) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, label string")
    flagged = with_stratified_test_flag(df, "row_id", "label", 0.3, leaf_rows=leaf_rows).toPandas()
    flagged["label"] = flagged["label"].fillna("none")
    for _, group in flagged.groupby("label"):
        assert group.is_test.sum() == int(0.3 * len(group))
    direct = with_stratified_test_flag(df, "row_id", "label", 0.3).toPandas()
    assert flagged.set_index("row_id").is_test.equals(direct.set_index("row_id").is_test.reindex(flagged.row_id))
    few = with_stratified_test_flag(df.limit(20), "row_id", "label")
    assert few.filter("is_test").isEmpty()
