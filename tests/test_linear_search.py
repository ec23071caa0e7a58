"""Linear families searched from sums, and scoring by registered parameters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.catalog.base import HOUR, hourly_features
from tickloom.operators import boosting as B, linear as L, serving as V
from tickloom.operators.models import contiguous_folds
from tickloom.operators.prep import add_target

FEATURES = ["close", "volume", "sma_7"]
STEP = HOUR * 1000


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    made = add_target(hourly_features(spark, sf_dir), 5, "target", step_ms=STEP)
    # Large values with small differences, and one feature that says nothing.
    return made.select("pair", "window_start_ms", "target", F.col("close"), (F.col("volume") + 1e6).alias("volume"), "sma_7")


def arrays(df):
    found = {}
    for r in df.orderBy("pair", "window_start_ms").collect():
        found.setdefault(r["pair"], []).append([*(r[c] for c in FEATURES), r["target"], r["fold"]])
    return {p: np.array(v) for p, v in found.items()}


def objective_slopes(x, y, intercept, beta, alpha, share):
    """How far each coefficient is from the minimum: 0 where the optimality conditions hold."""
    rest = y - intercept - x @ beta
    gradient = -(x.T @ rest) / len(y) + alpha * (1 - share) * beta
    return np.where(beta != 0, np.abs(gradient + alpha * share * np.sign(beta)), np.maximum(np.abs(gradient) - alpha * share, 0))


def test_search_on_the_whole_table_is_optimal_and_measured_right(spark, rows):
    test = rows.filter("window_start_ms % 7 = 0")
    trials, models = L.tune_linear(rows, test, FEATURES, "target", trials=3, folds=4, step_ms=STEP)
    board = trials.collect()
    known = contiguous_folds(L._complete(rows, FEATURES, "target"), 4, step_ms=STEP)
    data = arrays(known)
    held = arrays(L._complete(test, FEATURES, "target").withColumn("fold", F.lit(0)))
    assert len(board) == len(data) * 4 * 3
    # The fits themselves, from the same draws.
    import random
    drawn = {}
    for name in L.FAMILIES:
        draw = random.Random(f"{L.SEED}:{name}")
        for n in range(3):
            drawn[name, n] = L.search_space(name, draw)
    best = {}
    for r in board:
        params = drawn[r["model"], r["trial"]]
        assert r["params"] == str(sorted(params.items()))
        alpha, share, intercept = L.normalized(r["model"], params)
        own, off = data[r["pair"]], 0.0
        x, y, fold = own[:, :-2], own[:, -2], own[:, -1]

        def fitted(x, y):
            base = np.append(x.mean(axis=0), y.mean())
            wide = np.column_stack([x, y, np.ones(len(y))]) - np.append(base, 0)
            a, b = L.solve(wide.T @ wide, base, [(alpha, share, intercept)])[0]
            centred = x - x.mean(axis=0) if intercept else x
            slopes = objective_slopes(centred, y - y.mean() if intercept else y, 0.0, b, alpha, share)
            assert (slopes <= 1e-5 * np.abs(x).max() * np.abs(y).max()).all()
            return a, b

        for k in range(4):
            a, b = fitted(x[fold != k], y[fold != k])
            off += np.abs(x[fold == k] @ b + a - y[fold == k]).sum()
        assert r["cv_mae"] == pytest.approx(off / len(y), rel=1e-6)
        if r["chosen"]:
            a, b = fitted(x, y)
            t = held[r["pair"]]
            assert r["test_mae"] == pytest.approx(np.abs(t[:, :-2] @ b + a - t[:, -2]).mean(), rel=1e-6)
        else:
            assert r["test_mae"] is None
        best.setdefault((r["pair"], r["model"]), []).append((r["cv_mae"], r["trial"], r["chosen"]))
    for found in best.values():
        assert [f[2] for f in sorted(found)] == [True, False, False]
    assert models.count() == len(data) * 4


def test_jobs_do_not_follow_pairs_or_trials(spark, rows):
    def jobs(df, trials):
        group = f"linear-{id(df)}-{trials}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            L.tune_linear(df, df, FEATURES, "target", ("Ridge",), trials=trials, folds=2, step_ms=STEP)[0].collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6)))).withColumn("pair", F.concat("pair", F.col("copy").cast("string")))
    assert jobs(many, 8) <= jobs(rows, 2) + 3


def test_families_equal_the_closed_form(rows):
    from tickloom.operators.models import fit_linear

    mine = {(r["pair"], r["model"]): r for r in L.fit_families(rows, FEATURES, "target").collect()}
    for r in fit_linear(rows, FEATURES, "target", {"LinearRegression": 0.0}).collect():
        own = mine[r["pair"], r["model"]]
        assert own["coefficients"] == pytest.approx(r["coefficients"], rel=1e-5, abs=1e-8)
        assert own["intercept"] == pytest.approx(r["intercept"], rel=1e-5)
    assert {m for _, m in mine} == set(L.FAMILIES)


def test_odd_rows(spark):
    data = [("A", i, float(i), None if i == 3 else 2.0 * i, 1.0 + 3 * i) for i in range(12)]
    data += [("B", 0, 1.0, 1.0, 5.0), (None, 0, 1.0, 1.0, 5.0), ("C", 0, None, 1.0, 5.0), ("D", 0, float("nan"), 1.0, 5.0)]
    rows = spark.createDataFrame(data, "pair string, window_start_ms long, x double, z double, target double")
    found = {r["pair"]: r for r in L.fit_families(rows, ["x", "z"], "target", ("LinearRegression",)).collect()}
    assert set(found) == {"A", "B"}
    assert found["A"]["intercept"] + found["A"]["coefficients"][0] * 2 + found["A"]["coefficients"][1] * 4 == pytest.approx(7.0)
    assert found["B"]["intercept"] + sum(found["B"]["coefficients"]) == pytest.approx(5.0)
    assert L.fit_families(rows.limit(0), ["x"], "target").collect() == []


def test_newest_version_scores_and_the_baseline_answers_for_the_rest(spark, folder):
    rows = spark.createDataFrame([(p, i, float(10 * i), float(i), None if i == 2 else 1.0) for p in "ABC" for i in range(3)],
                                 "pair string, window_start_ms long, close double, x double, gap double")
    line = "pair string, model string, intercept double, coefficients array<double>"
    path = f"{folder}/parameters"
    assert V.read_parameters(spark, path).count() == 0
    assert {(r["prediction"], r["model"]) for r in V.score_rows(rows, V.read_parameters(spark, path), ["x"], 5).collect()} == {
        (0.0, None), (10.0, None), (20.0, None)}
    V.register_parameters(spark.createDataFrame([("A", "Ridge", 1.0, [2.0]), ("B", "Lasso", 5.0, [0.0])], line), path, ["x"], 5)
    for n in range(9):      # versions 2 to 10: the highest number counts, not the last by name
        V.register_parameters(spark.createDataFrame([("A", "Ridge", 1.0 + n, [100.0, 0.5])], line), path, ["gap", "x"], 5)
    V.register_parameters(spark.createDataFrame([("B", "Ridge", 7.0, [7.0])], line), path, ["x"], 60)
    table = V.read_parameters(spark, path)
    made = {(r["pair"], r["window_start_ms"]): r for r in V.score_rows(rows, table, ["x", "gap"], 5).collect()}
    assert len(made) == 9
    assert [made["A", i]["prediction"] for i in range(3)] == [109.0, 109.5, 20.0]       # a missing value: the baseline
    assert [made["A", i]["version"] for i in range(3)] == [10, 10, None]
    assert [made["B", i]["prediction"] for i in range(3)] == [5.0] * 3
    assert [(made["C", i]["prediction"], made["C", i]["model"]) for i in range(3)] == [(10.0 * i, None) for i in range(3)]


def test_boosted_models_score_by_the_table(spark, rows, folder):
    path = f"{folder}/parameters"
    models = B.fit_boosted(rows, FEATURES, "target", {"m": {"trees": 2, "depth": 2}})
    V.register_parameters(models, path, FEATURES, 5)
    made = V.score_rows(rows, V.read_parameters(spark, path), ["sma_7", "volume", "close"], 5)
    want = {(r["pair"], r["window_start_ms"]): r["prediction"] for r in B.predict_boosted(models, rows, FEATURES, "target").collect()}
    got = {(r["pair"], r["window_start_ms"]): r["prediction"] for r in made.collect()}
    assert got == want and made.filter("model <> 'm' OR model IS NULL").count() == 0
