"""Baseline, model tables, registry, training."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.functions.lookups import attach
from tickloom.operators import boosting as B, drift as X, linear as L, models as M, prep as P, selection as S, serving as V
from tickloom.operators.indicators import indicators
from tickloom.plans import training
from tickloom.session import materialize

STEP = HOUR * 1000
_DAY_MS = DAY * 1000
_WEEK_MS = 7 * _DAY_MS


def _targets(spark, sf):
    return P.add_target(hourly_features(spark, sf), 5, "target", step_ms=STEP)


def _board(spark, sf):
    """Leaderboard of simple forecasts: what the model tables below start from."""
    return M.leaderboard(forecasts(_targets(spark, sf), "target"), features=10)


BOARD = f"""{FORECASTS}, board AS (SELECT pair, model, count(*) AS n_samples,
  avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) ** 2)) AS rmse,
  1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) AS r2,
  1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) * (count(*) - 1) / (count(*) - 11) AS adjusted_r2
  FROM forecasts GROUP BY pair, model)"""
BOARD_OUT = (f"pair, model, n_samples, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('r2')} AS r2, "
             f"{r('adjusted_r2')} AS adjusted_r2")
RANKED = "row_number() OVER (PARTITION BY pair ORDER BY mae, model)"


@query(f"""WITH {FORECASTS} SELECT pair, count(*) AS n_samples, {r('avg(abs(actual - prediction))')} AS baseline_mae,
  {r('-avg(abs(actual - prediction))')} AS score FROM forecasts WHERE model = 'last' GROUP BY pair""")
def baseline_mae(spark, sf):
    return M.baseline_error(_targets(spark, sf), "target")


@query(f"WITH {BOARD} SELECT {BOARD_OUT} FROM board")
def leaderboard(spark, sf):
    return _board(spark, sf)


@query(f"WITH {BOARD}, ranked AS (SELECT *, {RANKED} AS rank FROM board) "
       f"SELECT {BOARD_OUT}, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 2")
def top_models(spark, sf):
    return M.top_models(_board(spark, sf), 2)


@query(f"WITH {BOARD}, ranked AS (SELECT *, {RANKED} AS rank FROM board) "
       f"SELECT {BOARD_OUT} FROM ranked WHERE rank = 1")
def best_tuned(spark, sf):
    return M.best_tuned(_board(spark, sf))


@query(f"WITH {BOARD}, ranked AS (SELECT *, {RANKED} AS rank FROM board) "
       f"SELECT {BOARD_OUT} FROM board SEMI JOIN (SELECT pair, model FROM ranked WHERE rank <= 2) USING (pair, model)")
def only_top_models(spark, sf):
    board = materialize(_board(spark, sf))
    return S.only_models(board, M.top_models(board, 2))


def _registry(spark, sf):
    """Registered versions: every week of forecasts counts as one version."""
    made = forecasts(_targets(spark, sf), "target").withColumn(
        "version", (F.expr(f"(window_start_ms - 1704067200000) div {_WEEK_MS}L") + 1).cast("int"))
    return made.filter(F.col("model") != "sma_14").groupBy("pair", "model", "version").agg(
        F.avg(F.abs(F.col("actual") - F.col("prediction"))).alias("mae")).withColumn("horizon", F.lit(5))


REGISTRY = f"""{BOARD}, registry AS (SELECT pair, model, 5 AS horizon,
  CAST((window_start_ms - 1704067200000) // {_WEEK_MS} + 1 AS INTEGER) AS version,
  avg(abs(actual - prediction)) AS mae FROM forecasts WHERE model <> 'sma_14' GROUP BY ALL),
latest AS (SELECT pair, model, horizon, max(version) AS version, arg_max(mae, version) AS mae
  FROM registry GROUP BY ALL),
base AS (SELECT pair, mae AS baseline_mae FROM board WHERE model = 'last'),
decided AS (SELECT board.pair, board.model, 5 AS horizon, board.mae, latest.version AS registered_version,
  latest.mae AS registered_mae, baseline_mae,
  latest.version IS NULL OR board.mae < latest.mae OR board.mae < baseline_mae AS register,
  CASE WHEN latest.version IS NULL THEN 'no existing model' WHEN board.mae < latest.mae THEN 'better than existing'
       WHEN board.mae < baseline_mae THEN 'better than baseline' ELSE 'not better' END AS reason
  FROM board LEFT JOIN latest ON latest.pair = board.pair AND latest.model = board.model
  LEFT JOIN base ON base.pair = board.pair)"""


@query(f"WITH {REGISTRY} SELECT pair, model, horizon, version, {r('mae')} AS mae FROM latest")
def latest_version(spark, sf):
    return M.latest_versions(_registry(spark, sf))


def _decisions(spark, sf):
    rows = materialize(_targets(spark, sf))
    board = M.leaderboard(forecasts(rows, "target"))
    candidates = board.select("pair", "model", "mae").withColumn("horizon", F.lit(5))
    return M.promotion(candidates, _registry(spark, sf), M.baseline_error(rows, "target"))


@query(f"""WITH {REGISTRY} SELECT pair, model, horizon, {r('mae')} AS mae, registered_version,
  {r('registered_mae')} AS registered_mae, {r('baseline_mae')} AS baseline_mae, register, reason FROM decided""")
def promotion(spark, sf):
    return _decisions(spark, sf)


@query(f"""WITH {REGISTRY} SELECT pair || '_' || model || '_5' AS name, pair, model, horizon,
  CAST(coalesce(registered_version, 0) + 1 AS INTEGER) AS version, {r('mae')} AS mae FROM decided WHERE register""")
def next_versions(spark, sf):
    return M.next_entries(_decisions(spark, sf).filter("register"), _registry(spark, sf)).drop("feature_columns")


# --- models in closed form ---------------------------------------------------------------

@query(f"""WITH {FORECASTS}, rows AS (SELECT pair, window_start_ms, close AS x, target AS y FROM targets WHERE target IS NOT NULL),
fits AS (SELECT pair, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx FROM rows GROUP BY pair),
models AS (SELECT *, 'LinearRegression' AS model, sxy / sxx AS beta FROM fits
           UNION ALL SELECT *, 'Ridge', sxy / (sxx + 1) FROM fits)
SELECT pair, model, window_start_ms, {r('y')} AS actual, {r('my + beta * (x - mx)')} AS prediction
FROM rows JOIN models USING (pair)""")
def linear_predictions(spark, sf):
    """Least squares and ridge on one feature, every pair in one pass; every row is scored."""
    rows = materialize(_targets(spark, sf).filter("target IS NOT NULL"))
    return M.predict_linear(M.fit_linear(rows, ["close"], "target"), rows, ["close"], "target")


@query(f"WITH {FORECASTS} SELECT pair, model, {METRICS}, {r('max(abs(actual - prediction))')} AS worst FROM forecasts GROUP BY pair, model")
def leaderboard_with_own_metric(spark, sf):
    """A metric of one's own beside the built-in ones."""
    worst = F.max(F.abs(F.col("actual") - F.col("prediction"))).alias("worst")
    return M.leaderboard(forecasts(_targets(spark, sf), "target"), extra=[worst])


# --- trained models: no SQL twin ------------------------------------------------------

#: Trees of each boosted model; the depth, leaves and penalties are those of `boosting.FAMILIES`.
TREES = 4


def _training_rows(spark, sf):
    """The full feature table, cleaned, scaled and split."""
    full = indicators(bars(spark, sf, HOUR), step_ms=STEP)
    ready, features, target = training.training_set(full, 5, step_ms=STEP)
    return ready, features, target


def _part(ready, name):
    return ready.filter(F.col("split") == name)


COLUMNS = ["pair", "model", "window_start_ms", "actual", "prediction"]


@query()
def model_leaderboard(spark, sf):
    """Regressor families on the full feature table, trained on the train part and measured on
    the test part: linear ones for all pairs at once, the others pair by pair."""
    ready, features, target = _training_rows(spark, sf)
    train, test = _part(ready, "train"), _part(ready, "test")
    others = M.train_families(train, features, target, [n for n in M.families() if n not in L.FAMILIES])
    made = M.predict_linear(L.fit_families(train, features, target), test, features, target).select(*COLUMNS)
    return M.leaderboard(made.union(M.predict_all(others, test, target).select(*COLUMNS)))


@query()
def boosted_leaderboard(spark, sf):
    """Three kinds of boosted trees on the full feature table, all pairs at once."""
    ready, features, target = _training_rows(spark, sf)
    boosted = B.fit_boosted(_part(ready, "train"), features, target, {n: {**p, "trees": TREES} for n, p in B.FAMILIES.items()})
    return M.leaderboard(B.predict_boosted(boosted, _part(ready, "test"), features, target).select(*COLUMNS))


@query()
def tuning_trials(spark, sf):
    """Seeded search of all linear families: 50 trials, five folds, every pair, full feature table."""
    ready, features, target = _training_rows(spark, sf)
    return L.tune_linear(_part(ready, "train"), _part(ready, "test"), features, target, step_ms=STEP)[0]


@query()
def scored_rows(spark, sf):
    """Every row of the feature table by its pair's best tuned model, with an error band from
    the validation residuals."""
    ready, features, target = _training_rows(spark, sf)
    trials, models = L.tune_linear(_part(ready, "train"), _part(ready, "test"), features, target, step_ms=STEP)
    chosen = M.best_tuned(trials.filter("chosen").select("pair", "model", F.col("test_mae").alias("mae")))
    path = f"{work_folder(spark)}/parameters"
    V.register_parameters(models.join(chosen.select("pair", "model"), ["pair", "model"]), path, features, 5)
    made = V.score_rows(ready, V.read_parameters(spark, path), features, 5).withColumn("actual", F.col(target))
    band = M.error_band(made.filter("split = 'validation' AND actual IS NOT NULL"))
    return attach(made, band, ["pair"]).select(
        "pair", "window_start_ms", "split", "model", "actual", "prediction",
        (F.col("prediction") + F.col("band_low")).alias("prediction_low"),
        (F.col("prediction") + F.col("band_high")).alias("prediction_high"))


# --- scoring by the registered parameters ------------------------------------------------

FITS = f"""{FORECASTS}, known AS (SELECT pair, window_start_ms, close AS x, target AS y FROM targets WHERE target IS NOT NULL),
fits AS (SELECT pair, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM known GROUP BY pair)"""


def _versions(spark, sf, path):
    """Version 1 for four products, version 2 for two of them, none for the fifth."""
    rows = materialize(_targets(spark, sf))
    yield rows
    V.register_parameters(L.fit_families(rows.filter("pair <> 'view'"), ["close"], "target", ("LinearRegression",)), path, ["close"], 5)
    yield 1
    V.register_parameters(L.fit_families(rows.filter("pair IN ('click', 'error')"), ["close"], "target", ("Ridge",)), path, ["close"], 5)
    yield 2


def _scores(version_2):
    ridge = f"pair IN ('click', 'error') AND {version_2}"
    return f"""WITH {FITS} SELECT pair, window_start_ms, {r('close')} AS close,
  CASE WHEN pair = 'view' THEN NULL WHEN {ridge} THEN 'Ridge' ELSE 'LinearRegression' END AS model,
  CAST(CASE WHEN pair = 'view' THEN NULL WHEN {ridge} THEN 2 ELSE 1 END AS INTEGER) AS version,
  {r(f'CASE WHEN pair = $$view$$ THEN close ELSE my + (close - mx) * sxy / (sxx + CASE WHEN {ridge} THEN 1 ELSE 0 END) END')} AS prediction
  FROM targets JOIN fits USING (pair) WHERE target IS NOT NULL""".replace("$$", "'")


@query(_scores("true"))
def scored_by_registry(spark, sf):
    """Every row by its pair's newest registered version; the baseline where there is none."""
    path = f"{work_folder(spark)}/parameters"
    rows, *_ = _versions(spark, sf, path)
    return V.score_rows(rows, V.read_parameters(spark, path), ["close"], 5).select(
        "pair", "window_start_ms", "close", "model", "version", "prediction")


@query(_scores(f"window_start_ms >= {SPLIT_MS}"))
def stream_scored_by_registry(spark, sf):
    """A stream of feature rows; version 2 is registered after the first micro-batch."""
    home = work_folder(spark)
    path, own = f"{home}/parameters", spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    steps = _versions(spark, sf, path)
    rows = next(steps).select("pair", "window_start_ms", "close")
    for part in (F.col("window_start_ms") < SPLIT_MS, F.col("window_start_ms") >= SPLIT_MS):
        next(steps)
        rows.filter(part).write.mode("append").parquet(f"{home}/rows")
        stream = own.readStream.schema(rows.schema).parquet(f"{home}/rows")
        V.scoring_stream(stream, path, ["close"], 5, f"{home}/scores", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{home}/scores").drop("batch")


@query(f"""WITH {FEATURES} SELECT pair, window_start_ms, {r('close')} AS close, {r('close')} AS prediction FROM features""")
def scored_fallback(spark, sf):
    """Without a registered model the baseline answers."""
    return M.score(hourly_features(spark, sf), None).select("pair", "window_start_ms", "close", "prediction")


@query(f"WITH {FORECASTS} SELECT pair, model, {METRICS}, {r('avg(prediction - actual)')} AS mean_error "
       "FROM forecasts WHERE model IN ('last', 'sma_7') GROUP BY pair, model")
def two_models_compared(spark, sf):
    """Reference and current model on the same actual values."""
    both = forecasts(_targets(spark, sf), "target").filter(F.col("model").isin("last", "sma_7"))
    return X.compare_models(both)
