"""Expectations, profiles and alerts."""

from __future__ import annotations

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.operators import dedup as D, quality as Q

_EXPECT = f"""{FEATURES}, m AS (SELECT count(*) AS n_rows, count(*) FILTER (close IS NULL) AS null_close,
  count(*) FILTER (window_start_ms IS NULL) AS null_ms, count(*) FILTER (close < 0) AS neg_close,
  count(*) FILTER (volume < 0) AS neg_volume FROM features),
o AS (SELECT count(*) - count(DISTINCT (pair, window_start_ms)) AS bad FROM features),
checks AS (
  SELECT 'row_count_between' AS expectation, CAST(NULL AS VARCHAR) AS "column", n_rows >= 10 AS success,
         0::BIGINT AS unexpected_count FROM m
  UNION ALL SELECT 'column_exists', c, c <> 'ema_7', 0 FROM (SELECT unnest([{', '.join(repr(c) for c in Q.REQUIRED_COLUMNS)}]) AS c)
  UNION ALL SELECT 'not_null', 'close', null_close = 0, null_close FROM m
  UNION ALL SELECT 'not_null', 'window_start_ms', null_ms = 0, null_ms FROM m
  UNION ALL SELECT 'of_type', 'close', true, 0
  UNION ALL SELECT 'of_type', 'window_start_ms', true, 0
  UNION ALL SELECT 'at_least_zero', 'close', neg_close = 0, neg_close FROM m
  UNION ALL SELECT 'at_least_zero', 'volume', neg_volume = 0, neg_volume FROM m
  UNION ALL SELECT 'increasing', 'window_start_ms', bad = 0, bad FROM o)"""


@query(f"WITH {_EXPECT} SELECT * FROM checks")
def expectations(spark, sf):
    """The feature rows lack ema_7, so one expectation fails."""
    return Q.expectations(hourly_features(spark, sf), strictly=True)


@query(f"""WITH {_EXPECT} SELECT count(*) AS evaluated, count(*) FILTER (success) AS successful,
  count(*) FILTER (NOT success) AS unsuccessful, {r('count(*) FILTER (success) * 100.0 / count(*)')} AS success_percent,
  bool_and(success) AS success FROM checks""")
def validation_summary(spark, sf):
    return Q.validation_summary(Q.expectations(hourly_features(spark, sf), strictly=True))


@query(f"""WITH {SUPPLIER}, steps AS (SELECT *, lag(timestamp_ms) OVER (PARTITION BY product_id ORDER BY seq) AS was
  FROM supplier_trades)
SELECT count(*) FILTER (timestamp_ms < was) AS unexpected_count FROM steps""")
def increasing_by_arrival(spark, sf):
    """Times against arrival order; line items do not arrive in order of shipping."""
    rows = supplier_trades(spark, sf).withColumnsRenamed({"product_id": "pair", "timestamp_ms": "window_start_ms"})
    return Q.expectations(rows, arrival="seq").filter(
        "expectation = 'increasing'").select("unexpected_count")


_LONG = f"""{FEATURES}, long AS (SELECT pair, "column", value FROM (
  UNPIVOT (SELECT pair, close, volume, sma_7, rsi_14 FROM features) ON close, volume, sma_7, rsi_14
  INTO NAME "column" VALUE value))"""


def _profile_sql(by: str) -> str:
    both = f'{by}"column"'
    return f"""WITH {_LONG}, sizes AS (SELECT {by}count(*) AS n_rows FROM features {'GROUP BY ' + by.rstrip(', ') if by else ''}),
tops AS (SELECT {both}, value, count(*) AS n, row_number() OVER (PARTITION BY {both} ORDER BY count(*) DESC, value) AS k
  FROM long GROUP BY {both}, value),
stats AS (SELECT {both}, count(*) AS count, count(DISTINCT value) AS distinct_count,
  {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min,
  {r('quantile_cont(value, 0.25)')} AS q25, {r('quantile_cont(value, 0.5)')} AS median,
  {r('quantile_cont(value, 0.75)')} AS q75, {r('max(value)')} AS max,
  count(*) FILTER (value = 0) AS zeros FROM long GROUP BY {both})
SELECT stats.*, n_rows - count AS missing, {r('tops.value')} AS top_value, tops.n AS top_count
FROM stats JOIN tops USING ({both}) JOIN sizes {'USING (' + by.rstrip(', ') + ')' if by else 'ON true'} WHERE k = 1"""


_PROFILED = ["close", "volume", "sma_7", "rsi_14"]


@query(_profile_sql(""))
def profile_columns(spark, sf):
    return Q.profile(hourly_features(spark, sf), _PROFILED)


@query(_profile_sql("pair, "))
def profile_by_pair(spark, sf):
    return Q.profile(hourly_features(spark, sf), _PROFILED, by=("pair",))


@query()
def profile_approximate(spark, sf):
    """Approximate quartiles and distinct counts, for which SQL has no equal twin."""
    return Q.approximate_profile(hourly_features(spark, sf), _PROFILED, by=("pair",))


_CORR = ["open", "high", "low", "close", "volume"]


@query(f"WITH {bars_sql()} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr({a}, {b})')} AS correlation FROM bars"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def correlations(spark, sf):
    return Q.correlations(bars(spark, sf), _CORR)


_RANKED = [*_CORR, "sma_7", "sma_14", "rsi_7", "rsi_14"]


@query(f"""WITH {FEATURES}, numbered AS (SELECT row_number() OVER () AS id, * FROM features), long AS (
  SELECT id, "column", value FROM (UNPIVOT (SELECT id, {', '.join(f'round({c}, 6) AS {c}' for c in _RANKED)} FROM numbered) ON {', '.join(_RANKED)}
  INTO NAME "column" VALUE value)),
ranked AS (SELECT id, "column", rank() OVER (PARTITION BY "column" ORDER BY value)
  + (count(*) OVER (PARTITION BY "column", value) - 1) / 2.0 AS v FROM long),
places AS (SELECT c AS "column", i FROM (SELECT unnest([{', '.join(repr(c) for c in _RANKED)}]) AS c, unnest(range({len(_RANKED)})) AS i))
SELECT x."column" AS column_a, y."column" AS column_b, {r('corr(x.v, y.v)')} AS correlation
FROM ranked x JOIN ranked y USING (id) JOIN places a ON a."column" = x."column" JOIN places b ON b."column" = y."column"
WHERE a.i < b.i GROUP BY 1, 2""")
def rank_correlations(spark, sf):
    """Spearman's; the first indicators of a pair are missing. Six digits of a value count, as
    averages that are equal on paper differ in their last bits."""
    return Q.correlations(rounded(hourly_features(spark, sf)), _RANKED, "spearman")


@query(f"""WITH {TRADES}, {SUPPLIER}, rates AS (
  SELECT (count(*) - count(DISTINCT (product_id, timestamp_ms))) / count(*) AS v FROM supplier_trades),
steps AS (SELECT product_id, timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY product_id ORDER BY timestamp_ms) AS g FROM trades),
gaps AS (SELECT product_id, count(*) AS v FROM steps WHERE g > 3600000 GROUP BY product_id)
SELECT 'duplicate_rate' AS alert, 'trades' AS subject, {r('v')} AS value, 0.01::DOUBLE AS threshold FROM rates WHERE v > 0.01
UNION ALL SELECT 'silence', product_id, v, 3 FROM gaps WHERE v > 3""")
def alerts(spark, sf):
    return Q.alerts(D.dedup_stats(supplier_trades(spark, sf), "trades"),
                    Q.feed_gaps(trades(spark, sf), 3600), 0.01, 3)
