import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import series
from tickloom.operators import models as M, prep as P, splits as L

STEP = 60_000


@pytest.fixture(params=["one cell", "many cells"])
def cells(request, monkeypatch):
    if request.param == "many cells":
        monkeypatch.setattr(series, "CELL_ROWS", 2)
        monkeypatch.setattr(series, "BLOCK_ROWS", 3)


def holed(spark):
    data = [("A", i * STEP, v) for i, v in enumerate(
        [None, None, 1.0, None, 4.0, None, None, 10.0, None])]
    data += [("B", i * STEP, None) for i in range(3)]
    return spark.createDataFrame(data, "pair string, window_start_ms long, x double")


def values(df, c="x", pair="A"):
    return [r[c] for r in df.filter(F.col("pair") == pair).orderBy("window_start_ms").collect()]


def test_fills(spark, cells):
    df = holed(spark)
    assert values(P.fill_missing(df, "ffill")) == [1, 1, 1, 1, 4, 4, 4, 10, 10]
    assert values(P.fill_missing(df, "bfill")) == [1, 1, 1, 4, 4, 10, 10, 10, 10]
    assert values(P.fill_missing(df, "interpolate")) == [1, 1, 1, 2.5, 4, 6, 8, 10, 10]
    assert values(P.fill_missing(df, "ffill"), pair="B") == [None] * 3
    assert P.fill_missing(df, "drop").count() == 3
    with pytest.raises(ValueError):
        P.fill_missing(df, "guess")


def test_interpolation_follows_time_not_rows(spark):
    df = spark.createDataFrame([("A", 0, 0.0), ("A", 10, None), ("A", 40, 8.0)],
                               "pair string, window_start_ms long, x double")
    assert values(P.fill_missing(df, "interpolate")) == [0, 2, 8]


def test_sparse_columns_go_strictly_above_the_threshold(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 80, 1.0).alias("at_80"), F.when(F.col("id") >= 81, 1.0).alias("at_81"),
        F.lit(None).cast("double").alias("empty"), F.col("id"))
    assert P.drop_sparse_columns(df, 0.8).columns == ["at_80", "id"]
    assert P.drop_sparse_columns(df, 1.0).columns == df.columns


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert P.missing_ratios(df).first().x == 0.5


def line(spark, n=12, pair="A"):
    return spark.createDataFrame([(pair, i * STEP, float(i)) for i in range(n)],
                                 "pair string, window_start_ms long, close double")


def test_target_by_rows_and_by_time(spark, cells):
    df = line(spark).filter(F.col("window_start_ms") != 3 * STEP)
    by_rows = {r.window_start_ms // STEP: r.future_close_2m for r in P.add_target(df, 2).collect()}
    by_time = {r.window_start_ms // STEP: r.future_close_2m for r in P.add_target(df, 2, by="time").collect()}
    assert by_rows[2] == 5.0 and by_rows[1] == 4.0 and max(by_rows) == 9
    assert 1 not in by_time and by_time[2] == 4.0 and max(by_time) == 9


def test_lags(spark, cells):
    out = P.add_lags(line(spark), ["close", "nope"], [1, 4]).orderBy("window_start_ms").collect()
    assert [(r.close, r.close_lag_1, r.close_lag_4) for r in out] == [
        (float(i), float(i - 1), float(i - 4)) for i in range(4, 12)]


def test_scalers(spark):
    x = np.array([1.0, 2.0, 4.0, 8.0, 16.0])
    df = spark.createDataFrame([("A", float(v), 5.0) for v in x] + [("B", 1.0, 1.0)],
                               "pair string, x double, flat double")
    std = P.apply_scaler(df, P.fit_scaler(df)).filter("pair = 'A'").orderBy("x").collect()
    assert np.allclose([r.x for r in std], (x - x.mean()) / x.std())
    assert {r.flat for r in std} == {0.0}
    rob = P.apply_scaler(df, P.fit_scaler(df, kind="robust")).filter("pair = 'A'").orderBy("x").collect()
    q = np.percentile(x, [25, 50, 75])
    assert np.allclose([r.x for r in rob], (x - q[1]) / (q[2] - q[0]))
    with pytest.raises(ValueError):
        P.fit_scaler(df, kind="magic")


def test_scaled_and_feature_columns(spark):
    df = spark.createDataFrame([("A", 1, 1, 2.0, 3.0, 4.0, "t")],
                               "pair string, window_start_ms long, n int, close double, "
                               "future_close_5m double, timestamp_x double, note string")
    assert P.scaled_columns(df) == ["close"]
    assert P.feature_matrix(df, "future_close_5m").columns == [
        "window_start_ms", "n", "close", "future_close_5m"]


# --- splits ---------------------------------------------------------------------------

@pytest.mark.parametrize("n,k", [(7, 5), (12, 5), (13, 3), (50, 5)])
def test_folds_follow_the_definition(spark, n, k, cells):
    size = n // (k + 1)
    got = [r.fold for r in L.rolling_folds(line(spark, n), k).orderBy("window_start_ms").collect()]
    want = [0] * n
    for i in range(1, k + 1):
        for at in range(n - (k - i + 1) * size, n - (k - i) * size):
            want[at] = i
    assert got == want
    split = [r.split for r in L.split_train_validation_test(line(spark, n), k).orderBy("window_start_ms").collect()]
    assert split == ["train" if f < k - 1 else "validation" if f == k - 1 else "test" for f in want]


def test_ratio_split_cuts_to_whole_rows(spark):
    split = [r.split for r in L.split_train_validation_test(line(spark, 11), 1).orderBy("window_start_ms").collect()]
    assert split == ["train"] * 7 + ["validation"] + ["test"] * 3


@pytest.mark.parametrize("n", [5, 11, 23])
def test_contiguous_folds(spark, n, cells):
    got = [r.fold for r in M.contiguous_folds(line(spark, n), 5).orderBy("window_start_ms").collect()]
    want = [i for i, part in enumerate(np.array_split(np.arange(n), 5)) for _ in part]
    assert got == want


def test_nan_is_missing(spark, cells):
    data = [("A", i * STEP, v) for i, v in enumerate([1.0, float("nan"), None, 4.0])]
    df = spark.createDataFrame(data, "pair string, window_start_ms long, x double")
    assert values(P.fill_missing(df, "ffill", step_ms=STEP)) == [1, 1, 1, 4]
    assert values(P.fill_missing(df, "interpolate", step_ms=STEP)) == [1, 2, 3, 4]
    assert values(P.fill_missing(df, "drop")) == [1, 4]


def test_sparse_columns_of_one_pair(spark):
    rows = [("A", float(i), float(i)) for i in range(5)] + [("B", float(i), None) for i in range(5)]
    df = spark.createDataFrame(rows, "pair string, x double, y double")
    made = P.blank_sparse(df, 0.8)
    assert values_of(made, "A") == [(i, i) for i in range(5)] and values_of(made, "B") == [(i, 0) for i in range(5)]
    assert P.drop_sparse_columns(df, 0.8).columns == df.columns


def values_of(df, pair):
    return [(r.x, r.y) for r in df.filter(F.col("pair") == pair).orderBy("x").collect()]
