"""Baseline, model comparison, hyper-parameter search and the model registry."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, FMRegressor, GBTRegressor, GeneralizedLinearRegression,
    LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tickloom.functions.lookups import attach
from tickloom.functions.metrics import adjusted_r2, mae, regression_metrics
from tickloom.functions.scalars import registered_name
from tickloom.functions.series import candle_cell, number_rows
from tickloom.schemas import REGISTRY as SCHEMA
from tickloom.session import materialize

SEED = 42


# --- baseline and tables of results ---------------------------------------------------

def persistence(df: DataFrame) -> DataFrame:
    """The baseline prediction: the price stays as it is."""
    return df.withColumn("prediction", F.col("close"))


def baseline_error(df: DataFrame, target: str, by: tuple[str, ...] = ("pair",)) -> DataFrame:
    """MAE of the baseline; its score is the negative, as higher means better."""
    error = mae(target, "prediction")
    return persistence(df).filter(F.col(target).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), error.alias("baseline_mae"), (-error).alias("score"))


def leaderboard(predictions: DataFrame, extra: list[Column] = (), features: int | None = None
                ) -> DataFrame:
    """Metrics of every pair and model, best MAE first within a pair.

    With the number of `features`, R2 adjusted for it. `extra` adds named metrics of one's own: aggregates over `actual` and `prediction`.
    """
    if features is not None:
        extra = [adjusted_r2("actual", "prediction", features).alias("adjusted_r2"), *extra]
    return predictions.groupBy("pair", "model").agg(
        *regression_metrics("actual", "prediction"), *extra).orderBy("pair", "mae", "model")


def top_models(board: DataFrame, n: int = 1) -> DataFrame:
    """The n best models of every pair, with their rank."""
    best = Window.partitionBy("pair").orderBy(F.asc("mae"), F.asc("model"))
    return board.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def best_tuned(trials: DataFrame) -> DataFrame:
    """The tuned model with the smallest MAE of every pair; the first name wins a tie."""
    return top_models(trials, 1).drop("rank")


# --- registry -------------------------------------------------------------------------

NAME = ("pair", "model", "horizon")


def latest_versions(registry: DataFrame) -> DataFrame:
    """The entry with the highest version number of each name."""
    newest = Window.partitionBy(*NAME).orderBy(F.desc("version"))
    return registry.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def promotion(candidates: DataFrame, registry: DataFrame, baseline: DataFrame) -> DataFrame:
    """Candidates with the registered and baseline MAE beside them, and the decision.

    A candidate is registered when its name is new, or it beats the registered version, or
    it beats the baseline.
    """
    known = latest_versions(registry).select(
        *NAME, F.col("version").alias("registered_version"), F.col("mae").alias("registered_mae"))
    base = baseline.select("pair", "baseline_mae")
    joined = candidates.join(known, list(NAME), "left").join(base, ["pair"], "left")
    new = F.col("registered_version").isNull()
    better = F.coalesce(F.col("mae") < F.col("registered_mae"), F.lit(False))
    beats = F.coalesce(F.col("mae") < F.col("baseline_mae"), F.lit(False))
    return joined.withColumn("register", new | better | beats).withColumn(
        "reason", F.when(new, "no existing model").when(better, "better than existing")
        .when(beats, "better than baseline").otherwise("not better"))


def next_entries(accepted: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows for accepted candidates, each with the next version of its name."""
    known = latest_versions(registry).select(*NAME, F.col("version").alias("_have"))
    joined = accepted.join(known, list(NAME), "left")
    features = (F.col("feature_columns") if "feature_columns" in accepted.columns
                else F.lit(None).cast("array<string>"))
    return joined.select(
        registered_name(F.col("pair"), F.col("model"), F.col("horizon")).alias("name"), *NAME,
        (F.coalesce("_have", F.lit(0)) + 1).cast("int").alias("version"), "mae",
        features.alias("feature_columns"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table at `path`; empty if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


BASELINE = "baseline"       # registered without a saved model: its prediction is the price


def register(accepted: DataFrame, registry_path: str,
             models: dict[tuple[str, str], PipelineModel] | None = None,
             model_path: str | None = None) -> list[str]:
    """Append the accepted candidates to the registry table, and save their models.

    `models` holds them by pair and model name; each is saved as name/version below
    `model_path` before its registry row appears. An entry without its model is refused (the
    baseline needs none). Returns the names with their versions.
    """
    registry = read_registry(accepted.sparkSession, registry_path)
    entries = materialize(next_entries(accepted, registry))
    # One row per pair and accepted model.
    listed = [r.asDict() for r in entries.select("name", "pair", "model", "version").collect()]
    saved = models or {}
    lacking = [e["name"] for e in listed if e["model"] != BASELINE and (e["pair"], e["model"]) not in saved]
    if lacking or (saved and model_path is None):
        raise ValueError(f"no model or no place to save it: {', '.join(lacking) or 'model_path'}")
    for entry in listed:
        model = saved.get((entry["pair"], entry["model"]))
        if model is not None:
            model.write().overwrite().save(f"{model_path}/{entry['name']}/{entry['version']}")
    entries.write.mode("append").parquet(registry_path)
    return [f"{e['name']}/{e['version']}" for e in listed]


def load_model(model_path: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{model_path}/{name}/{version}")


# --- training -------------------------------------------------------------------------

def families() -> dict:
    """Regressor families compared for each pair, with their default parameters."""
    return {
        "LinearRegression": LinearRegression(),
        "Ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0),
        "Lasso": LinearRegression(regParam=1.0, elasticNetParam=1.0),
        "ElasticNet": LinearRegression(regParam=1.0, elasticNetParam=0.5),
        "HuberRegressor": LinearRegression(loss="huber", epsilon=1.35),
        "DecisionTreeRegressor": DecisionTreeRegressor(seed=SEED),
        "RandomForestRegressor": RandomForestRegressor(seed=SEED),
        "GradientBoostingRegressor": GBTRegressor(seed=SEED),
        "GeneralizedLinearRegressor": GeneralizedLinearRegression(),
        "FMRegressor": FMRegressor(seed=SEED, stepSize=0.01),
    }


def _pairs(df: DataFrame) -> list[str]:
    return [r["pair"] for r in df.select("pair").distinct().orderBy("pair").collect()]


def _stages(estimator, features: list[str], target: str) -> Pipeline:
    prepared = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip")
    return Pipeline(stages=[prepared, estimator.copy().setFeaturesCol("_features")
                            .setLabelCol(target).setPredictionCol("prediction")])


def train_families(train: DataFrame, features: list[str], target: str,
                   names: list[str] | None = None, pairs: list[str] | None = None,
                   parallelism: int = 4) -> dict[tuple[str, str], PipelineModel]:
    """Fit every family on the training rows of every pair.

    Each fit is a distributed job over the rows of that pair; a few run at the same time.
    """
    chosen = {k: v for k, v in families().items() if names is None or k in names}
    todo = [(pair, name) for pair in (pairs or _pairs(train)) for name in chosen]

    def fit(item):
        pair, name = item
        rows = train.filter(F.col("pair") == pair)
        return item, _stages(chosen[name], features, target).fit(rows)

    with ThreadPoolExecutor(parallelism) as pool:
        return dict(pool.map(fit, todo))


# Ridge penalty of the families that one pass over sums of products fits.
CLOSED_FORM = {"LinearRegression": 0.0, "Ridge": 1.0}


def fit_linear(train: DataFrame, features: list[str], target: str,
               penalties: dict[str, float] | None = None) -> DataFrame:
    """Least squares for every pair at once: pair, model, n, intercept, coefficients.

    Every task adds up products of its rows per pair, Spark adds those up, and each pair's
    equations are solved where its few sums meet; the number of jobs does not depend on the
    number of pairs. The penalty is on the sum of squared coefficients, not on the
    intercept. Rows with an unknown value are left out. Sums are of distances from the pair's
    first row in the task, so that large values lose no digits.
    """
    penalties = penalties or CLOSED_FORM
    names, size = [*features, target], len(features) + 1
    rows = train.select("pair", *[F.col(c).cast("double").alias(c) for c in names]).na.drop()

    def add_up(batches):
        sums: dict[str, list] = {}
        for batch in batches:
            pairs = np.array(batch.column(0).to_pylist(), dtype=object)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            for pair in sorted(set(pairs.tolist())):
                own = values[pairs == pair]
                have = sums.setdefault(pair, [own[0].copy(), 0, np.zeros(size), np.zeros((size, size))])
                off = own - have[0]
                have[1] += len(off)
                have[2] += off.sum(axis=0)
                have[3] += off.T @ off
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), *(pa.array([np.asarray(s[i], float).tobytes() for s in sums.values()], pa.binary())
                                                  for i in range(4))], ["pair", "base", "n", "sums", "products"])

    def solve(table: pa.Table) -> pa.Table:
        parts = [[np.frombuffer(v) for v in row.values()] for row in table.drop(["pair"]).to_pylist()]
        base, n, first, second = parts[0][0], 0.0, np.zeros(size), np.zeros((size, size))
        for b, m, s, p in parts:
            shift = b - base
            n += m[0]
            second += p.reshape(size, size) + np.outer(s, shift) + np.outer(shift, s) + m[0] * np.outer(shift, shift)
            first += s + m[0] * shift
        centred, mean = second - np.outer(first, first) / n, base + first / n
        found = []
        for model, penalty in penalties.items():
            left = centred[:-1, :-1] + penalty * np.eye(size - 1)
            beta = np.linalg.lstsq(left, centred[:-1, -1], rcond=None)[0]
            found.append((model, int(n), float(mean[-1] - mean[:-1] @ beta), beta.tolist()))
        pair = table["pair"][0].as_py()
        model, count, intercept, beta = zip(*found)
        return pa.table({"pair": pa.array([pair] * len(found), pa.string()), "model": pa.array(model, pa.string()),
                         "n": pa.array(count, pa.int64()), "intercept": pa.array(intercept, pa.float64()),
                         "coefficients": pa.array(beta, pa.list_(pa.float64()))})

    partial = rows.mapInArrow(add_up, "pair string, base binary, n binary, sums binary, products binary")
    return partial.groupBy("pair").applyInArrow(
        solve, "pair string, model string, n long, intercept double, coefficients array<double>")


def predict_linear(coefficients: DataFrame, df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Predictions of all models of `fit_linear`, in the columns of `predict_all`.

    The coefficients are joined as one list per pair, broadcast while that is small.
    """
    models = coefficients.groupBy("pair").agg(F.collect_list(F.struct("model", "intercept", "coefficients")).alias("_models"))
    rows = attach(df, models, ["pair"], "inner", row_bytes=64 * (len(features) + 4))
    made = rows.select("pair", "window_start_ms", F.col(target).alias("actual"),
                       F.array(*[F.col(c).cast("double") for c in features]).alias("_x"), F.explode("_models").alias("_m"))
    value = F.aggregate(F.zip_with("_x", "_m.coefficients", lambda x, b: x * b), F.col("_m.intercept"), lambda a, v: a + v)
    return made.select("pair", F.col("_m.model").alias("model"), "window_start_ms", "actual", value.alias("prediction"))


def predict_all(models: dict[tuple[str, str], PipelineModel], df: DataFrame, target: str
                ) -> DataFrame:
    """Predictions of all models on the rows of their pair, in one DataFrame."""
    parts = [model.transform(df.filter(F.col("pair") == pair)).select(
        "pair", F.lit(name).alias("model"), "window_start_ms",
        F.col(target).alias("actual"), "prediction") for (pair, name), model in models.items()]
    return reduce(DataFrame.unionByName, parts)


def search_space(name: str, draw: random.Random) -> dict[str, object]:
    """One draw of the parameters of a family."""
    def log_uniform(low: float, high: float) -> float:
        import math
        return math.exp(draw.uniform(math.log(low), math.log(high)))

    # The ranges of the search.
    if name == "RandomForestRegressor":
        return {"numTrees": draw.randint(50, 500), "maxDepth": draw.randint(3, 30),
                "minInstancesPerNode": draw.randint(1, 10),
                "featureSubsetStrategy": draw.choice(["sqrt", "log2", "all"]),
                "bootstrap": draw.choice([True, False])}
    if name == "GradientBoostingRegressor":
        return {"maxIter": draw.randint(50, 500), "stepSize": draw.uniform(0.01, 0.3),
                "maxDepth": draw.randint(3, 10), "minInstancesPerNode": draw.randint(1, 10),
                "subsamplingRate": draw.uniform(0.7, 1.0),
                "featureSubsetStrategy": draw.choice(["sqrt", "log2", "all"])}
    if name == "DecisionTreeRegressor":
        return {"maxDepth": draw.randint(3, 30), "minInstancesPerNode": draw.randint(1, 10)}
    if name == "LinearRegression":
        return {"fitIntercept": draw.choice([True, False])}
    if name in ("Ridge", "Lasso"):
        return {"regParam": log_uniform(0.01, 10.0), "fitIntercept": draw.choice([True, False])}
    if name == "ElasticNet":
        return {"regParam": log_uniform(0.01, 10.0), "elasticNetParam": draw.uniform(0.1, 0.9),
                "fitIntercept": draw.choice([True, False])}
    if name == "HuberRegressor":
        return {"epsilon": draw.uniform(1.1, 2.0), "regParam": log_uniform(0.0001, 1.0),
                "fitIntercept": draw.choice([True, False]), "maxIter": draw.randint(100, 1000)}
    if name in ("GeneralizedLinearRegressor", "FMRegressor"):
        return {"fitIntercept": draw.choice([True, False]), "maxIter": draw.randint(100, 1000)}
    return {}


def contiguous_folds(df: DataFrame, folds: int = 5, keys: tuple[str, ...] = ("pair",),
                     step_ms: int = 60_000) -> DataFrame:
    """Add `fold` 0..folds-1: runs of rows in time order, the first ones one row longer."""
    numbered = number_rows(df, list(keys), ["window_start_ms"], candle_cell(step_ms), total="_n")
    at, size, extra = "(rn - 1)", f"(_n div {folds})", f"(_n % {folds})"
    wide = f"({size} + 1) * {extra}"
    return numbered.withColumn("fold", F.expr(
        f"CAST(CASE WHEN {at} < {wide} THEN {at} div ({size} + 1) "
        f"ELSE {extra} + ({at} - {wide}) div nullif({size}, 0) END AS INT)")).drop("rn", "_n")


def tune(train: DataFrame, test: DataFrame, features: list[str], target: str, names: list[str],
         trials: int = 50, folds: int = 5, seed: int = SEED, parallelism: int = 4,
         step_ms: int = 60_000) -> tuple[DataFrame, dict[tuple[str, str], PipelineModel]]:
    """Seeded random search per pair and family, by mean MAE over contiguous folds.

    Returns the trial table (pair, model, trial, params, cv_mae, test_mae, chosen) and the
    models refitted with the best parameters; `test_mae` belongs to the chosen trial.
    """
    spark = train.sparkSession
    measure = RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="mae")
    folded = materialize(contiguous_folds(train, folds, step_ms=step_ms), "pair", candle_cell(step_ms))

    def search(item):
        pair, name = item
        own, held = (df.filter(F.col("pair") == pair) for df in (folded, test))
        draw = random.Random(f"{seed}:{pair}:{name}")
        pipeline = _stages(families()[name], features, target)
        last = pipeline.getStages()[-1]
        drawn = [search_space(name, draw) for _ in range(trials)]
        found = CrossValidator(
            estimator=pipeline, evaluator=measure, numFolds=folds, foldCol="fold",
            estimatorParamMaps=[{last.getParam(k): v for k, v in d.items()} for d in drawn]).fit(own)
        test_mae = measure.evaluate(found.bestModel.transform(held))
        at = min(range(trials), key=lambda i: found.avgMetrics[i])
        return item, found.bestModel, [
            (pair, name, i, str(sorted(d.items())), float(found.avgMetrics[i]),
             float(test_mae) if i == at else None, i == at) for i, d in enumerate(drawn)]

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(search, [(p, n) for p in _pairs(train) for n in names]))
    best = {item: model for item, model, _ in done}
    rows = [row for _, _, trial_rows in done for row in trial_rows]
    table = spark.createDataFrame(
        rows, "pair string, model string, trial int, params string, cv_mae double, "
              "test_mae double, chosen boolean")
    return table, best


# --- scoring --------------------------------------------------------------------------

def error_band(predictions: DataFrame, low: float = 0.05, high: float = 0.95,
               accuracy: int = 10_000) -> DataFrame:
    """Residual quantiles of the validation rows, per pair."""
    residual = F.col("actual") - F.col("prediction")
    band = F.percentile_approx(residual, [low, high], accuracy)
    return predictions.groupBy("pair").agg(F.get(band, 0).alias("band_low"),
                                           F.get(band, 1).alias("band_high"))


def score(features: DataFrame, model: PipelineModel | None, band: DataFrame | None = None
          ) -> DataFrame:
    """Predictions for batch or streaming feature rows; the baseline without a model.

    With `band`, the prediction gets the pair's error band around it.
    """
    made = persistence(features) if model is None else model.transform(features).drop("_features")
    if band is None:
        return made
    joined = attach(made, band, ["pair"])
    edge: dict[str, Column] = {f"prediction_{side}": F.col("prediction") + F.col(f"band_{side}")
                               for side in ("low", "high")}
    return joined.withColumns(edge).drop("band_low", "band_high")
