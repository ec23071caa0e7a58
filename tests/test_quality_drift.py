import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import distribution as D
from tickloom.operators import drift as X, quality as Q


def frame(spark, columns):
    return spark.createDataFrame(list(zip(*[[float(v) for v in c] for c in columns.values()])),
                                 ", ".join(f"{n} double" for n in columns)).repartition(5)


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(5)
    many = np.round(rng.normal(size=1500), 2)
    heavy = np.where(rng.random(1500) < 0.4, 7.0, rng.integers(0, 5000, 1500) / 10)   # one hot value
    return {"many": many, "heavy": heavy, "same": np.full(1500, 3.0)}


@pytest.mark.parametrize("ranges", [4, 16, 256])
def test_cumulative_counts_and_quantiles(spark, samples, ranges):
    df = frame(spark, samples)
    out = D.cumulative(D.value_counts(D.long_form(df, list(samples))), ["n"], ranges=ranges)
    rows = {}
    for r in out.collect():
        rows.setdefault(r.column, []).append(r)
    for name, x in samples.items():
        part = sorted(rows[name], key=lambda r: r.value)
        uniq, counts = np.unique(x, return_counts=True)
        assert [r.value for r in part] == list(uniq)
        assert [r.cum_n for r in part] == list(np.cumsum(counts))
        assert {r.all_n for r in part} == {len(x)}
        assert [r.next_value for r in part] == [*uniq[1:], None]
    got = {r.column: r for r in D.quantiles(out, {"q": 0.37, "m": 0.5}).collect()}
    for name, x in samples.items():
        assert got[name].q == pytest.approx(np.quantile(x, 0.37))
        assert got[name].m == pytest.approx(np.median(x))


def brute_ks(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max(), float((np.abs(fa - fb)[:-1] * np.diff(points)).sum())


def test_numeric_drift_against_brute_force(spark, samples):
    rng = np.random.default_rng(6)
    current = {"many": rng.normal(0.3, 1, 700), "heavy": samples["heavy"][:700] * 1.0,
               "same": np.full(700, 3.0)}
    out = {r.column: r for r in X.numeric_drift(frame(spark, samples), frame(spark, current)).collect()}
    for name in samples:
        ks, ws = brute_ks(samples[name], current[name])
        assert out[name].ks_statistic == pytest.approx(ks)
        assert out[name].wasserstein == pytest.approx(ws)
        assert (out[name].n_reference, out[name].n_current) == (1500, 700)
        assert out[name].method == "wasserstein"
    assert out["many"].drifted and not out["heavy"].drifted and not out["same"].drifted
    share = X.drift_share(X.numeric_drift(frame(spark, samples), frame(spark, current)), "many").first()
    assert (share.columns, share.drifted_columns, share.dataset_drift, share.named_column_drift) == (3, 1, False, True)


def test_small_samples_use_the_ks_test(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=200), rng.normal(1.0, 1, 150)
    out = X.numeric_drift(frame(spark, {"x": a}), frame(spark, {"x": b})).first()
    assert out.method == "ks" and out.drifted


@pytest.mark.parametrize("x,p", [(0.5, 0.9639), (1.0, 0.27), (1.36, 0.0494), (1.63, 0.00984)])
def test_ks_p_value_at_tabulated_points(spark, x, p):
    """The limit distribution at x = D*sqrt(nm/(n+m)); here nm/(n+m) = 50."""
    df = spark.range(1).select(X.ks_p_value(F.lit(x / 50 ** 0.5), F.lit(100), F.lit(100)).alias("p"))
    assert df.first().p == pytest.approx(p, rel=5e-3)


@pytest.mark.parametrize("x,dof,p", [(3.841, 1, 0.05), (5.991, 2, 0.05), (7.815, 3, 0.05),
                                     (18.307, 10, 0.05), (15.086, 5, 0.01), (0.0, 4, 1.0)])
def test_chi_square_tail_at_tabulated_points(x, dof, p):
    assert X.chi_square_tail(x, dof) == pytest.approx(p, abs=2e-4)


def test_categorical_drift(spark):
    ref = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, "c string")
    cur = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70, "c string")
    row = X.categorical_drift(ref, cur, ["c"]).first()
    assert row.chi_square == pytest.approx(30 ** 2 / 60 + 30 ** 2 / 40) and row.drifted
    p, q = np.array([0.6, 0.4]), np.array([0.3, 0.7])
    m = (p + q) / 2
    js = np.sqrt(((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2)
    assert row.jensen_shannon == pytest.approx(js)
    same = X.categorical_drift(ref, ref, ["c"]).first()
    assert not same.drifted and same.jensen_shannon == 0


def test_mixed_columns(spark):
    ref = spark.range(2000).selectExpr("id % 10 AS x", "0D AS target", "if(id % 2 = 0, 'a', 'b') AS c")
    cur = spark.range(900).selectExpr("id % 10 + 5 AS x", "9D AS target", "if(id % 2 = 0, 'a', 'b') AS c")
    rows = {r.column: (r.kind, r.method, r.drifted) for r in X.data_drift(ref, cur, ("c",), ("target",)).collect()}
    assert rows == {"x": ("num", "wasserstein", True), "c": ("cat", "jensen_shannon", False)}


def test_error_over_time_against_brute_force(spark):
    day = X.DAY_MS
    rng = np.random.default_rng(2)
    ms = np.sort(rng.integers(0, 20 * day, 300))
    y, f = rng.normal(size=300), rng.normal(size=300)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(ms, y, f)],
                               "window_start_ms long, actual double, prediction double")
    for size, step in ((7, 1), (5, 2), (3, 4)):
        got = {r.window_start_ms: r for r in X.error_over_time(df, size, step).collect()}
        start, seen = ms[0], 0
        while start + size * day <= ms[-1]:
            inside = (ms >= start) & (ms < start + size * day)
            if inside.any():
                r, e = got[int(start)], y[inside] - f[inside]
                assert r.n_samples == inside.sum()
                assert r.mae == pytest.approx(np.abs(e).mean())
                assert r.rmse == pytest.approx(np.sqrt((e ** 2).mean()))
                assert r.r2 == pytest.approx(1 - (e ** 2).sum() / ((y[inside] - y[inside].mean()) ** 2).sum())
                seen += 1
            start += step * day
        assert len(got) == seen


def bars(spark, n=20, **columns):
    base = {"pair": "'A'", "open": "1D", "high": "1D", "low": "1D", "close": "1D + id", "volume": "1D",
            "window_start_ms": "id * 60000", "window_end_ms": "id * 60000 + 60000", "window_in_sec": "60",
            "sma_7": "1D", "ema_7": "1D", "rsi_7": "1D", **columns}
    return spark.range(n).selectExpr("id AS seq", *[f"{e} AS {c}" for c, e in base.items()])


def failed(df, **options):
    return {(r.expectation, r.column): r.unexpected_count
            for r in Q.expectations(df, **options).filter("NOT success").collect()}


def test_expectations(spark):
    assert failed(bars(spark)) == {}
    assert failed(bars(spark, 9)) == {("row_count_between", None): 0}
    assert failed(bars(spark).drop("rsi_7")) == {("column_exists", "rsi_7"): 0}
    assert failed(bars(spark, close="if(id < 3, NULL, 1D)")) == {("not_null", "close"): 3}
    assert failed(bars(spark, volume="if(id < 2, -1D, 1D)")) == {("at_least_zero", "volume"): 2}
    assert failed(bars(spark, close="CAST(id AS INT)")) == {("of_type", "close"): 0}
    late = bars(spark, window_start_ms="if(id = 10, 60000L, id * 60000)")
    assert failed(late, arrival="seq", cell=3) == {("increasing", "window_start_ms"): 1}
    repeat = bars(spark, window_start_ms="if(id = 10, 540000L, id * 60000)")
    assert failed(repeat, arrival="seq", cell=3) == {}
    assert failed(repeat, arrival="seq", cell=3, strictly=True) == {("increasing", "window_start_ms"): 1}
    assert failed(repeat, strictly=True) == {("increasing", "window_start_ms"): 1}
    summary = Q.validation_summary(Q.expectations(bars(spark, 9))).first()
    assert (summary.evaluated, summary.unsuccessful, summary.success) == (20, 1, False)


def test_profile(spark, samples):
    df = frame(spark, samples).withColumn("gone", F.lit(None).cast("double"))
    rows = {r.column: r for r in Q.profile(df).collect()}
    for name, x in samples.items():
        r = rows[name]
        assert (r["count"], r.missing, r.distinct_count) == (1500, 0, len(np.unique(x)))
        assert r.mean == pytest.approx(x.mean()) and r.std == pytest.approx(x.std(ddof=1), abs=1e-6)
        assert (r.min, r.max, r.zeros) == (x.min(), x.max(), (x == 0).sum())
    assert (rows["heavy"].top_value, rows["same"].top_count) == (7.0, 1500)
    assert (rows["gone"]["count"], rows["gone"].missing, rows["gone"].mean) == (0, 1500, None)


def test_feed_gaps_against_brute_force(spark):
    draw = random.Random(3)
    times = {p: sorted(draw.randint(0, 5_000_000) for _ in range(200)) for p in "AB"}
    df = spark.createDataFrame([(p, t) for p, ts in times.items() for t in ts], "product_id string, timestamp_ms long")
    got = {(r.product_id, r.last_ms, r.next_ms) for r in Q.feed_gaps(df, 40).collect()}
    want = {(p, a, b) for p, ts in times.items() for a, b in zip(ts, ts[1:]) if b - a > 40_000}
    assert got == want and want


def test_large_values_with_little_spread(spark):
    """Times in milliseconds: the squares need more digits than a double has."""
    x = 1.7e12 + np.arange(2000) % 7 * 0.01
    y = x + 0.02
    one, two = frame(spark, {"t": x}), frame(spark, {"t": y})
    row = Q.profile(one, ["t"]).first()
    assert row.std == pytest.approx(np.std(x - 1.7e12, ddof=1), rel=0.02)
    drift = X.numeric_drift(one, two, ["t"]).first()
    assert drift.wasserstein_normed == pytest.approx(np.mean(y - x) / np.std(x - 1.7e12), rel=0.02)
    rows = spark.createDataFrame([(int(i * X.DAY_MS / 50), float(a), float(a) + 0.01 * (i % 3)) for i, a in enumerate(x)],
                                 "window_start_ms long, actual double, prediction double")
    for r in X.error_over_time(rows, 7, 7).collect():
        part = rows.filter((F.col("window_start_ms") >= r.window_start_ms) & (F.col("window_start_ms") < r.window_end_ms))
        assert r.r2 == pytest.approx(X.compare_models(part, by=()).first().r2, abs=0.02)


def test_columns_without_values_on_a_side(spark):
    schema = "a double, b double, c double, d string"
    one = spark.createDataFrame([(1.0, float("nan"), None, "x"), (2.0, None, None, "y")], schema)
    two = spark.createDataFrame([(1.0, 5.0, None, None), (2.0, 6.0, None, None)], schema)
    numeric = {r.column: (r.method, r.drifted, r.n_reference, r.n_current) for r in X.numeric_drift(one, two, ["a", "b", "c"]).collect()}
    assert numeric == {"a": ("ks", False, 2, 2), "b": ("no values", True, 0, 2), "c": ("no values", False, 0, 0)}
    share = X.drift_share(X.data_drift(one, two, ("d",))).first()
    assert (share["columns"], share["drifted_columns"]) == (4, 2)


def enumerated_ks(apart, n, m):
    """The share of all orders of two samples that differ by `apart` / (n * m) somewhere."""
    hits = orders = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = j = 0
        left = False
        for step in range(n + m):
            i, j = (i + 1, j) if step in chosen else (i, j + 1)
            left |= abs(i * m - j * n) >= apart
        hits, orders = hits + left, orders + 1
    return hits / orders


@pytest.mark.parametrize("n,m", [(1, 1), (1, 6), (3, 4), (5, 5), (6, 4), (7, 2)])
def test_lattice_paths_equal_enumeration(n, m):
    for apart in range(n * m + 1):
        assert X.lattice_exit(apart, n, m) == pytest.approx(enumerated_ks(apart, n, m) if apart else 1.0, rel=1e-12)


def test_lattice_paths_of_disjoint_and_large_samples():
    assert X.lattice_exit(30 * 20, 30, 20) == pytest.approx(2 / math.comb(50, 20), rel=1e-9)
    # Near the limit distribution (1.36: 0.0494) where both samples are large.
    n = 4000
    assert X.lattice_exit(round(1.36 * (2 / n) ** 0.5 * n * n), n, n) == pytest.approx(0.0494, rel=0.02)


def test_exact_probability_decides_up_to_the_stated_size(spark):
    rng = np.random.default_rng(10)
    a, b = rng.normal(size=12), rng.normal(1.2, 1, 9)
    statistic = brute_ks(a, b)[0]
    exact = X.numeric_drift(frame(spark, {"x": a}), frame(spark, {"x": b})).first()
    assert exact.ks_p_value == pytest.approx(X.lattice_exit(round(statistic * 108), 12, 9))
    limit = [X.numeric_drift(frame(spark, {"x": a}), frame(spark, {"x": b}), exact_rows=k).first().ks_p_value for k in (0, 11)]
    assert limit[0] == limit[1] != exact.ks_p_value
    same = X.numeric_drift(frame(spark, {"x": a}), frame(spark, {"x": a})).first()
    assert same.ks_p_value == 1.0 and not same.drifted


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlations_of_sixty_columns(spark, method):
    """Ties, missing values, a value with a third of all rows, large values, a constant column."""
    rng = np.random.default_rng(11)
    data = pd.DataFrame({f"c{i}": np.round(rng.normal(size=3000) + 1e9 * (i == 3), i % 4) for i in range(60)})
    data["c7"] = 0.5 * data["c6"] + data["c7"]
    data.loc[::3, "c5"] = -0.0
    data.loc[1::3, "c5"] = 0.0
    data["c9"] = 0.1
    data.loc[::7, "c8"] = np.nan
    values = data.rank() if method == "spearman" else data
    wanted = values.corr()
    found = Q.correlations(spark.createDataFrame(data).repartition(5), method=method).collect()
    assert len(found) == 60 * 59 // 2
    for a, b, got in found:
        if "c9" in (a, b):
            assert got is None
        else:
            assert got == pytest.approx(wanted.loc[a, b], abs=1e-6 if "c3" in (a, b) else 1e-9)


def test_correlations_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b long, c double")
    for method in ("pearson", "spearman"):
        assert [tuple(r) for r in Q.correlations(empty, method=method).orderBy("column_a", "column_b").collect()] == [
            ("a", "b", None), ("a", "c", None), ("b", "c", None)]
