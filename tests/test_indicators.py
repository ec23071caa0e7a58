import math
import random

import numpy as np
import pytest

from tickloom.operators import indicators as I
from tickloom.schemas import CANDLE, PERIODS, feature_schema

P = 7


def make_bars(spark, n, pair="A", seed=1, constant=None):
    draw = random.Random(seed)
    data = []
    for i in range(n):
        close = constant if constant is not None else draw.randint(100, 900) / 10
        high = close if constant is not None else close + draw.randint(0, 50) / 10
        low = close if constant is not None else close - draw.randint(0, 50) / 10
        data.append((pair, close, high, low, close, float(draw.randint(0, 99)), i * 60_000, (i + 1) * 60_000, 60))
    return data, spark.createDataFrame(data, CANDLE)


def columns(data):
    return tuple(np.array([d[i] for d in data]) for i in (2, 3, 4, 5))


# --- step-by-step versions, written from the definitions ------------------------------

def ema_series(x, n, start):
    """EMA over n, seeded by the mean of the n values that end at `start`."""
    k = 2 / (n + 1)
    y = {start: sum(x[start - n + 1:start + 1]) / n}
    for t in range(start + 1, len(x)):
        y[t] = y[t - 1] + k * (x[t] - y[t - 1])
    return y


def movements(high, low):
    plus, minus = [0.0], [0.0]
    for t in range(1, len(high)):
        up, down = high[t] - high[t - 1], low[t - 1] - low[t]
        plus.append(up if up > down and up > 0 else 0.0)
        minus.append(down if down > up and down > 0 else 0.0)
    return plus, minus


def dx(p, m):
    return 100 * abs(p - m) / (p + m) if p + m > 0 else 0.0


def tail_reference(high, low, close, volume, p):
    n = len(close)
    out = dict.fromkeys(["sma", "ema", "rsi", "adx", "macd", "macdsignal", "macdhist"])
    if n >= p:
        out["sma"] = out["ema"] = sum(close[-p:]) / p
    if n >= p + 1:
        moves = [close[t] - close[t - 1] for t in range(n - p, n)]
        gain, loss = sum(m for m in moves if m > 0), -sum(m for m in moves if m < 0)
        out["rsi"] = 100 * gain / (gain + loss) if gain + loss else 0.0
    if n >= 2 * p:
        plus, minus = movements(high[-2 * p:], low[-2 * p:])
        sp, sm, total = sum(plus[1:p]), sum(minus[1:p]), 0.0
        for t in range(p, 2 * p):
            sp, sm = sp - sp / p + plus[t], sm - sm / p + minus[t]
            total += dx(sp, sm)
        out["adx"] = total / p
    if n >= 3 * p - 1:
        x = close[-(3 * p - 1):]
        fast, slow = ema_series(x, p, 2 * p - 1), ema_series(x, 2 * p, 2 * p - 1)
        line = [fast[t] - slow[t] for t in range(2 * p - 1, 3 * p - 1)]
        out["macd"], out["macdsignal"] = line[-1], sum(line) / p
        out["macdhist"] = out["macd"] - out["macdsignal"]
    return out


def full_reference(high, low, close, volume, p):
    n = len(close)
    rows = [dict.fromkeys(["ema", "rsi", "adx", "macd", "macdsignal", "macdhist"]) for _ in range(n)]
    if n >= p:
        for t, v in ema_series(close, p, p - 1).items():
            rows[t]["ema"] = v
    up = [0.0] + [max(close[t] - close[t - 1], 0) for t in range(1, n)]
    down = [0.0] + [max(close[t - 1] - close[t], 0) for t in range(1, n)]
    for t in range(p, n):
        if t == p:
            g, l = sum(up[1:p + 1]) / p, sum(down[1:p + 1]) / p
        else:
            g, l = (g * (p - 1) + up[t]) / p, (l * (p - 1) + down[t]) / p
        rows[t]["rsi"] = 100 * g / (g + l) if g + l > 0 else 0.0
    plus, minus = movements(high, low)
    sp, sm = sum(plus[1:p]), sum(minus[1:p])
    found = []
    for t in range(p, n):
        sp, sm = sp - sp / p + plus[t], sm - sm / p + minus[t]
        found.append(dx(sp, sm))
        if t == 2 * p - 1:
            adx = sum(found) / p
        elif t >= 2 * p:
            adx = (adx * (p - 1) + found[-1]) / p
        if t >= 2 * p - 1:
            rows[t]["adx"] = adx
    if n >= 3 * p - 1:
        fast, slow = ema_series(close, p, 2 * p - 1), ema_series(close, 2 * p, 2 * p - 1)
        line = [fast[t] - slow[t] if t >= 2 * p - 1 else 0.0 for t in range(n)]
        signal = sum(line[2 * p - 1:3 * p - 1]) / p
        for t in range(3 * p - 2, n):
            if t > 3 * p - 2:
                signal += 2 / (p + 1) * (line[t] - signal)
            rows[t] |= {"macd": line[t], "macdsignal": signal, "macdhist": line[t] - signal}
    return rows


def close_to(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-8)


@pytest.mark.parametrize("block", [None, 64])
def test_tail_equals_step_by_step(spark, monkeypatch, block):
    from tickloom.functions import series

    if block:
        monkeypatch.setattr(series, "BLOCK_ROWS", block)
        monkeypatch.setattr(series, "CELL_ROWS", 50)
    data, df = make_bars(spark, 260)
    other, df2 = make_bars(spark, 30, "B", seed=2)
    out = I.indicators(df.unionByName(df2).repartition(5))
    for name, part in (("A", data), ("B", other)):
        high, low, close, volume = columns(part)
        rows = sorted((r for r in out.collect() if r.pair == name), key=lambda r: r.window_start_ms)
        assert len(rows) == len(part)
        for t, r in enumerate(rows):
            for p in PERIODS:
                want = tail_reference(high[:t + 1], low[:t + 1], close[:t + 1], volume[:t + 1], p)
                assert all(close_to(r[f"{k}_{p}"], v) for k, v in want.items()), (name, t, p)
            assert r.obv == volume[t]


def test_full_equals_step_by_step(spark):
    data, df = make_bars(spark, 700)
    short, df2 = make_bars(spark, 15, "B", seed=5)
    out = I.indicators(df.unionByName(df2), (7, 21), seed="full").collect()
    for name, part in (("A", data), ("B", short)):
        high, low, close, volume = columns(part)
        rows = sorted((r for r in out if r.pair == name), key=lambda r: r.window_start_ms)
        for p in (7, 21):
            for r, want in zip(rows, full_reference(high, low, close, volume, p)):
                assert all(close_to(r[f"{k}_{p}"], v) for k, v in want.items()), (name, r.window_start_ms, p)
        total = 0.0
        for t, r in enumerate(rows):
            step = 1 if t == 0 else np.sign(close[t] - close[t - 1])
            total += step * volume[t]
            assert r.obv == total
            if t >= 6:
                assert close_to(r.sma_7, close[t - 6:t + 1].mean())


@pytest.mark.parametrize("kind,need", [("sma", 7), ("ema", 7), ("rsi", 8), ("adx", 14), ("macd", 20),
                                       ("macdsignal", 20), ("macdhist", 20)])
@pytest.mark.parametrize("seed", ["tail", "full"])
def test_null_until_history_is_there(spark, kind, need, seed):
    for n, there in ((need - 1, False), (need, True)):
        _, df = make_bars(spark, n)
        last = I.indicators(df, (P,), seed=seed).orderBy("window_start_ms").collect()[-1]
        assert (last[f"{kind}_{P}"] is not None) == there


def test_constant_prices(spark):
    _, df = make_bars(spark, 25, constant=50.0)
    for seed in ("tail", "full"):
        last = I.indicators(df, (P,), seed=seed).orderBy("window_start_ms").collect()[-1]
        assert (last.rsi_7, last.adx_7) == (0.0, 0.0)
        assert last.sma_7 == 50.0 and abs(last.macd_7) < 1e-9


def test_history_cap_blanks_what_can_never_be_known(spark):
    _, df = make_bars(spark, 200)
    last = I.indicators(df, max_history=60).orderBy("window_start_ms").collect()[-1]
    blank = {c for c in last.asDict() if last[c] is None}
    assert blank == {"rsi_60", "adx_60", "macd_21", "macdsignal_21", "macdhist_21",
                     "macd_60", "macdsignal_60", "macdhist_60"}


def test_assembled_row_has_the_table_columns(spark):
    _, df = make_bars(spark, 10)
    assert I.assemble(I.indicators(df)).schema.names == feature_schema().names
    assert len(feature_schema().names) == 39


def test_macd_weights_reproduce_the_recurrence():
    x = [random.Random(4).random() for _ in range(20)]
    line, signal = I.macd_weights(7)
    want = tail_reference(x, x, x, x, 7)
    assert math.isclose(np.dot(line, x), want["macd"], abs_tol=1e-12)
    assert math.isclose(np.dot(signal, x), want["macdsignal"], abs_tol=1e-12)
