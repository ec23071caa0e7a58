"""Technical indicators, tail and full mode."""

from __future__ import annotations

from tickloom.catalog.base import *  # noqa: F403
from pyspark.sql import functions as F

from tickloom.catalog.base import ORACLES, query, r
from tickloom.operators.indicators import indicators
from tickloom.plans.features import feature_table as build_features
from tickloom.schemas import PERIODS

STEP = HOUR * 1000
BASE = f"WITH {bars_sql()}, {MOVES}"


def _tail(spark, sf, *kinds, **options):
    return indicators(bars(spark, sf), kinds=kinds, step_ms=STEP, **options).select(
        "pair", "window_start_ms", *[f"{k}_{p}" for p in PERIODS for k in kinds])


def _select(columns: dict[str, str], head: str = BASE, source: str = "moves") -> str:
    return (f"{head} SELECT pair, window_start_ms, "
            + ", ".join(f"{r(e)} AS {c}" for c, e in columns.items()) + f" FROM {source}")


def _macd_tail(p: int) -> dict[str, str]:
    """Step by step over the list of closes: seeds, then both averages bar by bar."""
    need, fast, slow = 3 * p - 1, 2 / (p + 1), 2 / (2 * p + 1)
    x = f"(list(close) {frame(need)})"
    f0, s0 = f"list_avg({x}[{p + 1}:{2 * p}])", f"list_avg({x}[1:{2 * p}])"
    start = f"{{'f': {f0}, 's': {s0}, 't': {f0} - {s0}}}"
    rest = f"list_transform({x}[{2 * p + 1}:], lambda v: {{'f': v, 's': v, 't': 0.0::DOUBLE}})"
    f, s = f"(a.f + {fast!r} * (b.f - a.f))", f"(a.s + {slow!r} * (b.s - a.s))"
    end = (f"list_reduce(list_prepend({start}, {rest}), "
           f"lambda a, b: {{'f': {f}, 's': {s}, 't': a.t + {f} - {s}}})")

    def known(e: str) -> str:
        return f"CASE WHEN rn >= {need} THEN {e} END"

    line, signal = f"({end}).f - ({end}).s", f"({end}).t / {p}"
    return {f"macd_{p}": known(line), f"macdsignal_{p}": known(signal),
            f"macdhist_{p}": known(f"({line}) - {signal}")}


def _adx_tail(p: int) -> str:
    seed = (f"OVER (PARTITION BY pair ORDER BY window_start_ms "
            f"ROWS BETWEEN {2 * p - 2} PRECEDING AND {p} PRECEDING)")
    keep = (p - 1) / p
    start = f"{{'n': sum(plus - minus) {seed}, 'g': sum(plus + minus) {seed}, 's': 0.0::DOUBLE}}"
    moves = f"list({{'n': plus - minus, 'g': plus + minus, 's': 0.0::DOUBLE}}) {frame(p)}"
    step = (f"{{'n': a.n * {keep!r} + x.n, 'g': a.g * {keep!r} + x.g, 's': a.s + CASE WHEN a.g * {keep!r} + x.g > 0 "
            f"THEN 100 * abs(a.n * {keep!r} + x.n) / (a.g * {keep!r} + x.g) ELSE 0 END}}")
    return (f"CASE WHEN rn >= {2 * p} THEN list_reduce(list_prepend({start}, {moves}), "
            f"lambda a, x: {step}).s / {p} END")


@query(_select({f"sma_{p}": sma_sql(p) for p in PERIODS}))
def sma(spark, sf):
    return _tail(spark, sf, "sma")


@query(_select({f"ema_{p}": sma_sql(p) for p in PERIODS}))
def ema_tail(spark, sf):
    return _tail(spark, sf, "ema")


@query(_select({f"rsi_{p}": rsi_sql(p) for p in PERIODS}))
def rsi_tail(spark, sf):
    return _tail(spark, sf, "rsi")


@query(_select({f"adx_{p}": _adx_tail(p) for p in PERIODS}))
def adx_tail(spark, sf):
    return _tail(spark, sf, "adx")


@query(_select({c: e for p in PERIODS for c, e in _macd_tail(p).items()}))
def macd_tail(spark, sf):
    return _tail(spark, sf, "macd", "macdsignal", "macdhist")


@query(_select({"obv": "volume"}))
def obv_tail(spark, sf):
    return indicators(bars(spark, sf), kinds=("sma",), step_ms=STEP).select("pair", "window_start_ms", "obv")


CAPPED = {}
for _p in PERIODS:
    CAPPED |= {f"sma_{_p}": sma_sql(_p), f"ema_{_p}": sma_sql(_p),
               f"rsi_{_p}": rsi_sql(_p) if _p + 1 <= 60 else "CAST(NULL AS DOUBLE)",
               f"adx_{_p}": _adx_tail(_p) if 2 * _p <= 60 else "CAST(NULL AS DOUBLE)"}
    CAPPED |= _macd_tail(_p) if 3 * _p - 1 <= 60 else {
        f"{k}_{_p}": "CAST(NULL AS DOUBLE)" for k in ("macd", "macdsignal", "macdhist")}

FLAGSHIP = (f"{BASE} SELECT {CANDLE_OUT}, " + ", ".join(f"{r(e)} AS {c}" for c, e in CAPPED.items())
            + f", {r('volume')} AS obv, CAST(NULL AS TIMESTAMP) AS created_at FROM moves")


@query(FLAGSHIP)
def feature_table(spark, sf):
    """Trades to the full feature row, with the 60 candles of history the feed keeps."""
    return build_features(trades(spark, sf), HOUR, max_history=60)


# --- full mode ------------------------------------------------------------------------
# y[t] = a*y[t-1] + u[t] in closed form; an hourly month is short enough for pow(a, -rn).

RUN = "OVER (PARTITION BY pair ORDER BY rn ROWS UNBOUNDED PRECEDING)"


def _scan(a: float, u: str) -> str:
    return f"sum(({u}) * pow({a!r}, -rn)) {RUN} * pow({a!r}, rn)"


def _seeded(start: int, first: int, count: int, column: str, weight: float, scale: float = 1.0) -> str:
    """Input that puts the mean of `count` values from row `first` on at row `start`."""
    mean = f"(sum(CASE WHEN rn BETWEEN {first} AND {first + count - 1} THEN {column} END) OVER (PARTITION BY pair)) * {scale / count!r}"
    return f"CASE WHEN rn = {start} THEN {mean} WHEN rn > {start} THEN {column} * {weight!r} ELSE 0 END"


def _full(spark, sf, *kinds):
    return indicators(bars(spark, sf), kinds=kinds, step_ms=STEP, seed="full").select(
        "pair", "window_start_ms", *[f"{k}_{p}" for p in PERIODS for k in kinds])


def _levels(*levels: dict[str, str]) -> str:
    """CTEs of which each adds columns to the one before."""
    out, source = BASE, "moves"
    for i, level in enumerate(levels):
        out += f", l{i} AS (SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in level.items()) + f" FROM {source})"
        source = f"l{i}"
    return out


_ema = _levels({f"u{p}": _seeded(p, 1, p, "close", 2 / (p + 1)) for p in PERIODS},
               {f"y{p}": _scan(1 - 2 / (p + 1), f"u{p}") for p in PERIODS})


@query(_select({f"ema_{p}": f"CASE WHEN rn >= {p} THEN y{p} END" for p in PERIODS}, _ema, "l1"))
def ema_full(spark, sf):
    return _full(spark, sf, "ema")


_rsi = _levels({f"u{s}{p}": _seeded(p + 1, 2, p, s, 1 / p) for p in PERIODS for s in ("up", "down")},
               {f"y{s}{p}": _scan((p - 1) / p, f"u{s}{p}") for p in PERIODS for s in ("up", "down")})


@query(_select({f"rsi_{p}": f"CASE WHEN rn > {p} THEN CASE WHEN yup{p} + ydown{p} > 0 "
                            f"THEN 100 * yup{p} / (yup{p} + ydown{p}) ELSE 0 END END"
                for p in PERIODS}, _rsi, "l1"))
def rsi_full(spark, sf):
    return _full(spark, sf, "rsi")


_macd = _levels(
    {f"u{n}_{p}": _seeded(2 * p, first, n, "close", 2 / (n + 1))
     for p in PERIODS for n, first in ((p, p + 1), (2 * p, 1))},
    {f"m{p}": f"({_scan(1 - 2 / (p + 1), f'u{p}_{p}')}) - ({_scan(1 - 2 / (2 * p + 1), f'u{2 * p}_{p}')})"
     for p in PERIODS},
    {f"v{p}": _seeded(3 * p - 1, 2 * p, p, f"m{p}", 2 / (p + 1)) for p in PERIODS},
    {f"s{p}": _scan(1 - 2 / (p + 1), f"v{p}") for p in PERIODS})


@query(_select({f"{k}_{p}": f"CASE WHEN rn >= {3 * p - 1} THEN {e} END" for p in PERIODS
                for k, e in (("macd", f"m{p}"), ("macdsignal", f"s{p}"), ("macdhist", f"m{p} - s{p}"))},
               _macd, "l3"))
def macd_full(spark, sf):
    return _full(spark, sf, "macd", "macdsignal", "macdhist")


_adx = _levels(
    {f"u{s}{p}": _seeded(p, 2, p - 1, s, 1.0, float(p - 1)) for p in PERIODS for s in ("plus", "minus")},
    {f"y{s}{p}": _scan((p - 1) / p, f"u{s}{p}") for p in PERIODS for s in ("plus", "minus")},
    {f"dx{p}": f"CASE WHEN yplus{p} + yminus{p} > 0 THEN 100 * abs(yplus{p} - yminus{p}) / (yplus{p} + yminus{p}) ELSE 0 END"
     for p in PERIODS},
    {f"v{p}": _seeded(2 * p, p + 1, p, f"dx{p}", 1 / p) for p in PERIODS},
    {f"a{p}": _scan((p - 1) / p, f"v{p}") for p in PERIODS})


@query(_select({f"adx_{p}": f"CASE WHEN rn >= {2 * p} THEN a{p} END" for p in PERIODS}, _adx, "l4"))
def adx_full(spark, sf):
    return _full(spark, sf, "adx")


@query(f"""{BASE} SELECT pair, window_start_ms,
  {r(f"sum(CASE WHEN rn = 1 THEN volume ELSE sign(d) * volume END) {RUN}")} AS obv FROM moves""")
def obv_full(spark, sf):
    return indicators(bars(spark, sf), kinds=("ema",), step_ms=STEP, seed="full").select(
        "pair", "window_start_ms", "obv")


# --- unknown candles --------------------------------------------------------------------
# What follows an unknown candle is a run of its own: the same SQL over (pair, run).

HOLE = "(window_start_ms // 3600000) % 97 = 5"
IN_RUNS = f"""WITH {TRADES}, all_bars AS ({candle_sql(HOUR)}),
counted AS (SELECT *, count(*) FILTER ({HOLE}) OVER (PARTITION BY pair ORDER BY window_start_ms) AS run FROM all_bars),
bars AS (SELECT * REPLACE (pair || '#' || run AS pair) FROM counted WHERE NOT ({HOLE})), {MOVES}"""


def holes(spark, sf):
    """Hourly candles of which some have no price: NULL, or NaN at even days."""
    rows = bars(spark, sf)
    gone = F.expr("(window_start_ms div 3600000) % 97 = 5")
    nothing = F.when(F.expr("(window_start_ms div 86400000) % 2 = 0"), F.lit(float("nan")))
    return rows.withColumns({c: F.when(gone, nothing).otherwise(F.col(c)) for c in ("high", "low", "close")})


def _with_holes(sql: str, columns: list[str]) -> str:
    return (sql.replace(BASE, IN_RUNS).replace("SELECT pair, window_start_ms", "SELECT split_part(pair, '#', 1) AS pair, window_start_ms")
            + " UNION ALL SELECT pair, window_start_ms, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in columns)
            + f" FROM all_bars WHERE {HOLE}")


def _gappy(name: str, full: bool, *kinds: str) -> None:
    columns = [f"{k}_{p}" for p in PERIODS for k in kinds]

    def run(spark, sf):
        made = indicators(holes(spark, sf), kinds=kinds, step_ms=STEP, seed="full" if full else "tail")
        return made.select("pair", "window_start_ms", *columns)

    query(_with_holes(ORACLES[name], columns), name=f"{name}_gappy")(run)


_gappy("rsi_tail", False, "rsi")
_gappy("adx_tail", False, "adx")
_gappy("macd_tail", False, "macd", "macdsignal", "macdhist")
_gappy("ema_full", True, "ema")
_gappy("adx_full", True, "adx")
_gappy("macd_full", True, "macd", "macdsignal", "macdhist")
