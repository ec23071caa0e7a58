"""Boosted trees of all pairs against a grower that loops over rows, features and cuts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.catalog.base import HOUR, hourly_features
from tickloom.operators import boosting as B
from tickloom.operators.prep import add_target

FEATURES = ["close", "volume", "sma_7", "rsi_7"]
MODELS = {
    "plain": {"trees": 3, "depth": 2, "learning_rate": 0.5},
    "penalties": {"trees": 2, "depth": 3, "reg_lambda": 2.0, "reg_alpha": 5.0, "gamma": 1.0, "min_child_weight": 9},
    "leaves": {"trees": 2, "depth": 4, "leaves": 5, "min_child_weight": 4},
}


def shrunk(g, alpha):
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def grow(bins, y, p):
    """Trees by node number, as (feature, cut) of splits and values of leaves, and the predictions."""
    p = {**B.DEFAULTS, **p}
    base = float(np.float32(sum(y) / len(y)))
    scale = max(max(y) - base, base - min(y)) or 1.0
    pred, trees = [base] * len(y), []

    def score(g, h):
        return shrunk(g * scale / B.UNIT, p["reg_alpha"]) ** 2 / (h + p["reg_lambda"]) if h + p["reg_lambda"] > 0 else 0.0

    for _ in range(p["trees"]):
        # Half up, away from zero, as SQL rounds.
        g = [int(math.copysign(math.floor(abs(v) + 0.5), v)) for v in ((a - b) / scale * B.UNIT for a, b in zip(pred, y))]
        members, splits, open_ = {1: list(range(len(y)))}, {}, {}

        def look(node):
            rows = members[node]
            total, best = sum(g[i] for i in rows), None
            if node.bit_length() > p["depth"]:
                return
            for f in range(len(bins[0])):
                for cut in range(B.BINS):
                    left = [i for i in rows if bins[i][f] <= cut]
                    if min(len(left), len(rows) - len(left)) < max(p["min_child_weight"], 1):
                        continue
                    gl = sum(g[i] for i in left)
                    gain = 0.5 * (score(gl, len(left)) + score(total - gl, len(rows) - len(left)) - score(total, len(rows))) - p["gamma"]
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, f, cut
            if best:
                open_[node] = best

        look(1)
        while open_ and (not p["leaves"] or len(splits) + 1 < p["leaves"]):
            node = max(open_, key=lambda n: (open_[n][0], -n))
            _, f, cut = open_.pop(node)
            splits[node] = f, cut
            members[2 * node] = [i for i in members[node] if bins[i][f] <= cut]
            members[2 * node + 1] = [i for i in members[node] if bins[i][f] > cut]
            look(2 * node)
            look(2 * node + 1)
        values = {}
        for node in set(members) - set(splits):
            total = sum(g[i] for i in members[node])
            values[node] = -p["learning_rate"] * shrunk(total * scale / B.UNIT, p["reg_alpha"]) / (len(members[node]) + p["reg_lambda"])
            for i in members[node]:
                pred[i] += values[node]
        trees.append((splits, values))
    return trees, pred


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    made = add_target(hourly_features(spark, sf_dir), 5, "target", step_ms=HOUR * 1000)
    return made.select("pair", "window_start_ms", "target", *FEATURES)


def test_trees_equal_a_plain_grower_on_the_whole_table(spark, rows):
    models = B.fit_boosted(rows, FEATURES, "target", MODELS)
    found = {(r["pair"], r["model"]): r for r in models.collect()}
    known = rows.filter("target IS NOT NULL")
    cuts = B.materialize(B.cuts_of(known, FEATURES))
    predicted = {(r["pair"], r["model"], r["window_start_ms"]): r["prediction"]
                 for r in B.predict_boosted(models, rows, FEATURES, "target").collect()}
    by_pair = {}
    for r in B.binned(known, FEATURES, cuts).collect():
        by_pair.setdefault(r["pair"], []).append(r)
    limits = {r["pair"]: r["cuts"] for r in cuts.collect()}
    assert set(found) == {(p, m) for p in by_pair for m in MODELS}
    for (pair, name), model in found.items():
        own = by_pair[pair]
        trees, pred = grow([r["bins"] for r in own], [r["target"] for r in own], MODELS[name])
        assert model["n"] == len(own) and len(model["trees"]) == len(trees)
        for made, (splits, values) in zip(model["trees"], trees):
            assert {n for n, f in enumerate(made["feature"]) if f is not None} == set(splits)
            for n, (f, cut) in splits.items():
                assert made["feature"][n] == f
                assert made["threshold"][n] == (limits[pair][f][cut - 1] if cut else -math.inf)
            for n, value in values.items():
                assert made["value"][n] == pytest.approx(value, rel=1e-9, abs=1e-12)
        for r, value in zip(own, pred):
            assert predicted[pair, name, r["window_start_ms"]] == pytest.approx(value, rel=1e-9)


def test_bins_count_the_cuts_below(rows):
    cuts = B.materialize(B.cuts_of(rows, FEATURES))
    limits = {r["pair"]: r["cuts"] for r in cuts.collect()}
    for r in B.binned(rows, FEATURES, cuts).collect():
        for i, c in enumerate(FEATURES):
            assert r["bins"][i] == (0 if r[c] is None else 1 + sum(x < r[c] for x in limits[r["pair"]][i]))


def test_the_same_trees_however_rows_are_spread(spark, rows):
    def trees(df, partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        made = B.fit_boosted(df, FEATURES, "target", {"drawn": {"trees": 2, "subsample": 0.7, "colsample": 0.5}})
        return sorted((r["pair"], r["trees"]) for r in made.collect())

    try:
        assert trees(rows.repartition(1), 2) == trees(rows.repartition(7), 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_jobs_do_not_follow_the_pairs(spark, rows):
    """Ten times the pairs, one of them with a third of all rows: as many jobs and more rows only."""
    def jobs(df):
        group = f"jobs-{id(df)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            made = B.fit_boosted(df, FEATURES, "target", {"small": {"trees": 1, "depth": 2}})
            assert made.count() == df.filter("target IS NOT NULL").select("pair").distinct().count()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).withColumn(
        "pair", F.when((F.col("pair") == "view") & (F.col("copy") < 9), "hot").otherwise(F.concat("pair", F.col("copy").cast("string"))))
    assert jobs(many) <= jobs(rows) + 2


def test_odd_rows(spark):
    rows = spark.createDataFrame(
        [("A", i, float(i % 4), None if i % 3 else float(i), 1.0 if i % 3 else 9.0) for i in range(40)]
        + [("flat", i, 2.0, 1.0, 5.0) for i in range(6)] + [("one", 1, 1.0, 1.0, 3.0), ("none", 1, 1.0, 1.0, None), ("nan", 1, float("nan"), None, 1.0)],
        "pair string, window_start_ms long, x double, gap double, target double")
    models = B.fit_boosted(rows, ["x", "gap"], "target", {"m": {"trees": 1, "depth": 1, "learning_rate": 1.0}})
    got = {(r["pair"], r["window_start_ms"]): r["prediction"] for r in B.predict_boosted(models, rows, ["x", "gap"], "target").collect()}
    # What is missing is told from what is known.
    assert all(got["A", i] == pytest.approx(1.0 if i % 3 else 9.0, abs=1e-5) for i in range(40))
    assert got["flat", 0] == 5.0 and got["one", 1] == 3.0 and got["nan", 1] == 1.0 and ("none", 1) not in got
    assert B.fit_boosted(rows.limit(0), ["x"], "target", {"m": {"trees": 1}}).collect() == []


def test_best_split_takes_the_first_of_equal_gains():
    g, h = np.zeros((2, B.BINS + 1), np.int64), np.zeros((2, B.BINS + 1), np.int64)
    g[:, 1], g[:, 5], h[:, 1], h[:, 5] = -B.UNIT, B.UNIT, 1, 1
    assert B.best_split(g, h, B.DEFAULTS)[:2] == (0, 1)
