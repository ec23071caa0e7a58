import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import models as M
from tickloom.operators.indicators import indicators
from tickloom.operators.prep import add_target
from tickloom.operators.selection import only_models
from tickloom.plans import training
from tickloom.plans.features import feature_table
from tickloom.schemas import CANDLE

STEP = 60_000


@pytest.fixture(scope="module")
def table(spark):
    """Two pairs of 240 candles whose close follows a wave plus noise."""
    draw, data = random.Random(11), []
    for pair, level in (("A/EUR", 50), ("B/EUR", 80)):
        for i in range(240):
            close = level + 10 * np.sin(i / 15) + draw.random()
            data.append((pair, close, close + 1, close - 1, float(close), float(draw.randint(1, 9)),
                         i * STEP, (i + 1) * STEP, 60))
    bars = spark.createDataFrame([tuple(float(v) if 0 < j < 6 else v for j, v in enumerate(d)) for d in data], CANDLE)
    from tickloom.session import materialize
    return materialize(indicators(bars, (7,), kinds=("sma", "rsi")))


def test_baseline(spark):
    df = spark.createDataFrame([("A", 1.0, 3.0), ("A", 2.0, 1.0), ("A", 2.0, None)], "pair string, close double, t double")
    row = M.baseline_error(df, "t").first()
    assert (row.n_samples, row.baseline_mae, row.score) == (2, 1.5, -1.5)


def test_leaderboard_metrics_and_top(spark):
    rng = np.random.default_rng(0)
    y, f, g = rng.normal(size=50), rng.normal(size=50), rng.normal(size=50)
    df = spark.createDataFrame([("A", m, float(a), float(b)) for m, p in (("f", f), ("g", g)) for a, b in zip(y, p)],
                               "pair string, model string, actual double, prediction double")
    board = M.leaderboard(df, extra=[F.max(F.abs(F.col("actual") - F.col("prediction"))).alias("worst")])
    rows = {r.model: r for r in board.collect()}
    for name, p in (("f", f), ("g", g)):
        e = y - p
        assert rows[name].mae == pytest.approx(np.abs(e).mean())
        assert rows[name].rmse == pytest.approx(np.sqrt((e ** 2).mean()))
        assert rows[name].r2 == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
        assert rows[name].worst == pytest.approx(np.abs(e).max())
    best = min(rows, key=lambda m: rows[m].mae)
    assert [r.model for r in M.top_models(board, 1).collect()] == [best] == [r.model for r in M.best_tuned(board).collect()]
    assert {r.model for r in only_models(board, M.top_models(board, 1)).collect()} == {best}


def test_latest_version_is_a_number_not_text(spark):
    registry = spark.createDataFrame([("A", "m", 5, 9, 1.0), ("A", "m", 5, 10, 2.0), ("A", "m", 15, 3, 4.0)],
                                     "pair string, model string, horizon int, version int, mae double")
    assert {(r.horizon, r.version, r.mae) for r in M.latest_versions(registry).collect()} == {(5, 10, 2.0), (15, 3, 4.0)}


def test_promotion_and_registration(spark, folder):
    schema = "pair string, model string, horizon int, mae double"
    registry = spark.createDataFrame([("A/EUR", "old", 5, 2, 1.0), ("A/EUR", "worse", 5, 1, 1.0), ("A/EUR", "base", 5, 7, 1.0)],
                                     "pair string, model string, horizon int, version int, mae double")
    candidates = spark.createDataFrame([("A/EUR", "old", 5, 0.5), ("A/EUR", "worse", 5, 1.5), ("A/EUR", "base", 5, 1.2),
                                        ("A/EUR", "new", 5, 9.0), ("A/EUR", "equal", 5, 3.0)], schema)
    baseline = spark.createDataFrame([("A/EUR", 1.3)], "pair string, baseline_mae double")
    out = {r.model: (r.register, r.reason) for r in M.promotion(candidates, registry, baseline).collect()}
    assert out == {"old": (True, "better than existing"), "worse": (False, "not better"),
                   "base": (True, "better than baseline"), "new": (True, "no existing model"),
                   "equal": (True, "no existing model")}
    path = f"{folder}/registry"
    named = candidates.withColumn("model", F.lit("baseline"))
    M.register(named.filter("mae = 9.0"), path)
    M.register(named.filter("mae = 0.5"), path)
    rows = {(r.name, r.version, r.mae) for r in spark.read.parquet(path).collect()}
    assert rows == {("A_EUR_baseline_5", 1, 9.0), ("A_EUR_baseline_5", 2, 0.5)}
    with pytest.raises(ValueError):
        M.register(candidates.filter("model = 'new'"), path)


def test_training_set_fits_on_the_training_rows(table):
    ready, features, target = training.training_set(table, 5)
    assert target == "future_close_5m" and "window_start_ms" not in features and "price" not in features
    train = ready.filter("split = 'train' AND pair = 'A/EUR'").agg(F.avg("close"), F.stddev_pop("close")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
    everything, _, _ = training.training_set(table, 5, fit_on="all")
    assert everything.filter("pair = 'A/EUR'").agg(F.avg("close")).first()[0] == pytest.approx(0, abs=1e-9)


def test_train_compare_tune_and_score(table, spark, folder):
    ready, features, target = training.training_set(table, 5)
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    names = ["LinearRegression", "Ridge", "DecisionTreeRegressor"]
    fitted = M.train_families(train, features, target, names)
    board = M.leaderboard(M.predict_all(fitted, test, target)).collect()
    assert {(r.pair, r.model) for r in board} == {(p, n) for p in ("A/EUR", "B/EUR") for n in names}
    assert all(np.isfinite([r.mae, r.rmse, r.r2]).all() for r in board)
    base = {r.pair: r.baseline_mae for r in M.baseline_error(test.withColumn("close", F.col("price")), target).collect()}
    assert min(r.mae for r in board if r.pair == "A/EUR") < base["A/EUR"]

    trials, best = M.tune(train, test, features, target, ["Ridge"], trials=2, folds=3)
    rows = trials.collect()
    assert len(rows) == 4 and sum(r.chosen for r in rows) == 2 and set(best) == {("A/EUR", "Ridge"), ("B/EUR", "Ridge")}
    again, _ = M.tune(train, test, features, target, ["Ridge"], trials=2, folds=3)
    assert [(r.params, round(r.cv_mae, 9)) for r in again.collect()] == [(r.params, round(r.cv_mae, 9)) for r in rows]

    band = M.error_band(M.predict_all({k: v for k, v in fitted.items() if k[1] == "Ridge"},
                                      ready.filter("split = 'validation'"), target))
    scored = M.score(test.filter("pair = 'A/EUR'"), fitted[("A/EUR", "Ridge")], band).first()
    assert scored.prediction_low <= scored.prediction <= scored.prediction_high
    chosen = trials.filter("chosen").selectExpr("pair", "model", "5 AS horizon", "test_mae AS mae")
    names = M.register(chosen, f"{folder}/registry", best, f"{folder}/models")
    assert sorted(names) == ["A_EUR_Ridge_5/1", "B_EUR_Ridge_5/1"]
    loaded = M.load_model(f"{folder}/models", "A_EUR_Ridge_5", 1)
    rows = test.filter("pair = 'A/EUR'")
    assert M.score(rows, loaded).select("prediction").collect() == M.score(
        rows, best[("A/EUR", "Ridge")]).select("prediction").collect()
    assert M.score(test, None).filter("prediction <> close").count() == 0


def test_every_family_fits_and_every_space_draws(table):
    ready, features, target = training.training_set(table, 5)
    one = ready.filter("pair = 'A/EUR'")
    fitted = M.train_families(one, features, target, pairs=["A/EUR"])
    assert {n for _, n in fitted} == set(M.families())
    for name, estimator in M.families().items():
        drawn = M.search_space(name, random.Random(1))
        assert drawn and all(estimator.hasParam(k) for k in drawn)


def test_whole_training_plan(table, folder):
    out = training.run(table, trials=1, folds=2, families=["Ridge", "Lasso"],
                       registry_path=f"{folder}/registry", model_path=f"{folder}/models")
    assert len(out["registered"]) == 4 and set(out["models"]) == {(r.pair, r.model) for r in out["promotion"].collect()}
    name, _, version = next(n for n in out["registered"] if "baseline" not in n).partition("/")
    assert M.load_model(f"{folder}/models", name, int(version)) is not None
    assert out["leaderboard"].count() == 4
    decided = out["promotion"].collect()
    assert {r.pair for r in decided} == {"A/EUR", "B/EUR"} and all(r.register for r in decided)
    assert add_target(table, 5).count() == table.count() - 10


def test_feature_plan_removes_repeated_trades(spark):
    trades = spark.range(300).selectExpr("'A' AS product_id", "1D + id % 17 AS price", "1D AS quantity",
                                         "id * 20000 AS timestamp_ms", "id AS seq")
    again = trades.withColumn("seq", F.col("seq") + 1000)
    once = feature_table(trades, 60, (7,)).orderBy("window_start_ms").collect()
    twice = feature_table(trades.unionByName(again), 60, (7,)).orderBy("window_start_ms").collect()
    assert once == twice and len(once) == 100


def test_scoring_a_stream(table, spark, folder):
    """The same model and band on streaming feature rows."""
    ready, features, target = training.training_set(table, 5)
    fitted = M.train_families(ready, features, target, ["Ridge"], pairs=["A/EUR"])
    band = M.error_band(M.predict_all(fitted, ready, target))
    one = ready.filter("pair = 'A/EUR'")
    one.write.parquet(f"{folder}/features")
    rows = spark.readStream.schema(one.schema).parquet(f"{folder}/features")
    made = M.score(rows, fitted[("A/EUR", "Ridge")], band).select("window_start_ms", "prediction", "prediction_low")
    made.writeStream.option("checkpointLocation", f"{folder}/state").format("parquet").option(
        "path", f"{folder}/scored").trigger(availableNow=True).start().awaitTermination()
    batch = M.score(one, fitted[("A/EUR", "Ridge")], band).select("window_start_ms", "prediction", "prediction_low")

    def rounded(df):
        return {(r[0], round(r[1], 9), round(r[2], 9)) for r in df.collect()}

    assert rounded(spark.read.parquet(f"{folder}/scored")) == rounded(batch) and batch.count() == one.count()


def test_training_on_the_full_table_keeps_short_pairs(spark):
    """The table as it comes from the features plan, unstored, with a pair of 100 candles."""
    draw = random.Random(5)
    rows = [(pair, float(draw.randint(50, 99)), 1.0, i * STEP + 1, i) for pair, n in (("LONG", 400), ("NEW", 100)) for i in range(n)]
    trades = spark.createDataFrame(rows, "product_id string, price double, quantity double, timestamp_ms long, seq long")
    ready, features, target = training.training_set(feature_table(trades, 60, max_history=60), 5)
    counts = {r["pair"]: r["count"] for r in ready.groupBy("pair").count().collect()}
    assert counts["NEW"] > 30 and counts["LONG"] > 300
    assert "sma_60" in features and "adx_60" not in features and target not in features
    assert ready.filter(" OR ".join(f"{c} IS NULL" for c in [*features, target])).count() == 0
    assert set(M.train_families(ready.filter("split = 'train'"), features, target, ["Ridge"])) == {("LONG", "Ridge"), ("NEW", "Ridge")}


def test_training_horizon_limits_the_rows(table):
    with pytest.raises(ValueError):
        training.run(table, days=1)


def test_linear_models_of_many_pairs_in_one_pass(spark):
    """Against numpy, with large offsets; the number of jobs does not follow the pairs."""
    rng = np.random.default_rng(4)
    rows, wanted = [], {}
    for k in range(200):
        x = rng.normal(size=(12, 2)) + 1e7
        y = x @ [2.0, -1.0] + k + rng.normal(size=12) * 0.1
        rows += [(f"P{k}", i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
        mx, my = x.mean(axis=0), y.mean()
        beta = np.linalg.solve((x - mx).T @ (x - mx) + np.eye(2), (x - mx).T @ (y - my))
        wanted[f"P{k}"] = my + (x - mx) @ beta
    df = spark.createDataFrame(rows, "pair string, window_start_ms long, a double, b double, y double").repartition(7)

    def jobs(n):
        spark.sparkContext.setJobGroup(f"linear{n}", "")
        some = df.filter(F.substring("pair", 2, 9).cast("int") < n)
        found = M.predict_linear(M.fit_linear(some, ["a", "b"], "y"), some, ["a", "b"], "y").collect()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"linear{n}"))

    (few, one), (all_, two) = jobs(5), jobs(200)
    spark.sparkContext.setJobGroup("tests", "")
    assert len(few) == 5 * 12 * 2 and len(all_) == 200 * 12 * 2 and two <= one + 2
    for r in all_:
        if r.model == "Ridge":
            assert r.prediction == pytest.approx(wanted[r.pair][r.window_start_ms], abs=1e-4)
