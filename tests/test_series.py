import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import series as S

KEY = ["pair"]


@pytest.fixture()
def rows(spark):
    """One hot pair, a small one, one with a single row; gaps in time; shuffled."""
    draw = random.Random(7)
    data = []
    for pair, n in (("hot", 900), ("small", 60), ("one", 1)):
        ms = 0
        for i in range(n):
            ms += draw.choice([1, 1, 1, 2, 50])
            data.append((pair, ms, float(draw.randint(0, 1000)) / 10, i + 1))
    draw.shuffle(data)
    return spark.createDataFrame(data, "pair string, ms long, x double, want long").repartition(7)


def test_number_rows(rows):
    out = S.number_rows(rows, KEY, ["ms"], S.time_cell("ms", 10), total="n")
    assert out.filter("rn <> want").count() == 0
    assert {(r.pair, r.n) for r in out.select("pair", "n").distinct().collect()} == {
        ("hot", 900), ("small", 60), ("one", 1)}


def test_number_rows_shuffles_by_cell_not_by_key(rows):
    plan = S.number_rows(rows, KEY, ["ms"], S.time_cell("ms", 10))._jdf.queryExecution().executedPlan().toString()
    by_cell = [line for line in plan.splitlines() if "row_number()" in line]
    assert by_cell and all("_cell" in line for line in by_cell)


@pytest.mark.parametrize("before,after,block", [(3, 0, 16), (0, 5, 16), (20, 2, 8), (1, 1, 1)])
def test_halo_equals_whole_window(rows, before, after, block):
    from pyspark.sql import Window

    numbered = S.number_rows(rows, KEY, ["ms"], S.time_cell("ms", 10))
    blocks, w = S.with_halo(numbered, KEY, before, after, block_rows=block)
    made = S.drop_halo(blocks.withColumn("s", F.sum("x").over(w.rowsBetween(-before, after))))
    plain = rows.withColumn("s", F.sum("x").over(
        Window.partitionBy("pair").orderBy("ms").rowsBetween(-before, after)))
    got = {(r.pair, r.ms): r.s for r in made.collect()}
    want = {(r.pair, r.ms): r.s for r in plain.collect()}
    assert got.keys() == want.keys() and len(got) == made.count()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("later", [False, True])
def test_nearest_known(rows, later):
    holed = rows.withColumn("x", F.when(F.col("x") > 60, F.col("x")))
    name = "_next" if later else "_prev"
    out = S.nearest_known(holed, KEY, "ms", S.time_cell("ms", 10), ["x"], later, at="ms").collect()
    by_pair = {}
    for r in out:
        by_pair.setdefault(r.pair, []).append(r)
    for part in by_pair.values():
        part.sort(key=lambda r: r.ms, reverse=later)
        known = (None, None)
        for r in part:
            known = (r.x, r.ms) if r.x is not None else known
            assert (r[f"{name}_x"], r[f"{name}_at_x"]) == known


def loop(a, u):
    y, out = 0.0, []
    for v in u:
        y = a * y + v
        out.append(y)
    return np.array(out)


@pytest.mark.parametrize("a", [0.0, 0.3, 0.75, 59 / 60, 0.9999, 1.0])
def test_affine_scan_over_three_levels(spark, a):
    n, size = 70_000, 32      # more than two groups of 256 blocks of 32
    x = np.random.default_rng(1).normal(size=n)
    df = spark.createDataFrame([("p", i + 1, float(v)) for i, v in enumerate(x)],
                               "pair string, rn long, x double").repartition(8)
    out = S.affine_scan(df, KEY, {"y": (a, "x")}, rows=size).orderBy("rn").toPandas()["y"].to_numpy()
    want = loop(a, x)
    assert len(out) == n
    assert np.allclose(out, want, rtol=1e-9, atol=1e-9)


def test_affine_scan_keeps_ratio_over_a_flat_stretch(spark):
    """Two smoothers decay alike, so their ratio survives thousands of quiet rows."""
    data = [("p", i + 1, 3.0 if i == 5 else 0.0, 1.0 if i == 5 else 0.0) for i in range(3000)]
    df = spark.createDataFrame(data, "pair string, rn long, u double, d double")
    last = S.affine_scan(df, KEY, {"a": (0.9, "u"), "b": (0.9, "d")}).orderBy(F.desc("rn")).first()
    assert last.b > 0 and last.a / last.b == pytest.approx(3.0)


def test_scan_rows_refuses_periods_out_of_range():
    assert S.scan_rows([0.75, 1.0], 100) == S.SCAN_ROWS
    with pytest.raises(ValueError):
        S.scan_rows([0.1], 2000)


def test_one_long_series_is_spread_over_bounded_groups(spark, monkeypatch):
    """No window group grows with the series, also when one pair holds most rows."""
    monkeypatch.setattr(S, "BLOCK_ROWS", 500)
    monkeypatch.setattr(S, "CELL_ROWS", 400)
    df = spark.range(20_000).selectExpr(
        "if(id % 10 < 9, 'hot', 'cold') AS pair", "id * 60000 AS window_start_ms", "1D AS close")
    numbered = S.number_rows(df, KEY, ["window_start_ms"], S.candle_cell(60_000))
    cells = df.groupBy("pair", S.candle_cell(60_000).alias("c")).count()
    assert cells.agg(F.max("count")).first()[0] <= 400
    blocks, _ = S.with_halo(numbered, KEY, before=60)
    sizes = blocks.groupBy("pair", "_block").count().collect()
    assert max(r["count"] for r in sizes) <= 560
    assert sum(r["pair"] == "hot" for r in sizes) >= 36
    spread = blocks.repartition(8, "pair", "_block").filter("pair = 'hot'").select(
        F.spark_partition_id().alias("p")).distinct().count()
    assert spread == 8
