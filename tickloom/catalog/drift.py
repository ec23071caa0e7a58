"""Drift between two halves of the month, and model errors over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.base import *  # noqa: F403
from tickloom.catalog.base import query, r
from tickloom.operators import drift as X, prep as P

_DAY_MS = DAY * 1000
COLUMNS = ["open", "high", "low", "close", "volume"]

_SIDES = f"""{bars_sql()}, long AS (SELECT window_start_ms < {SPLIT_MS} AS ref, "column", value FROM (
  UNPIVOT (SELECT window_start_ms, {', '.join(COLUMNS)} FROM bars) ON {', '.join(COLUMNS)} INTO NAME "column" VALUE value)),
counts AS (SELECT "column", value, count(*) FILTER (ref) AS a, count(*) FILTER (NOT ref) AS b FROM long GROUP BY 1, 2),
cum AS (SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY "column") AS na,
  sum(b) OVER (PARTITION BY "column") AS nb, lead(value) OVER w AS nxt FROM counts
  WINDOW w AS (PARTITION BY "column" ORDER BY value)),
drift AS (SELECT "column", CAST(max(na) AS BIGINT) AS n_reference, CAST(max(nb) AS BIGINT) AS n_current,
  max(abs(ca / na - cb / nb)) AS ks, sum(abs(ca / na - cb / nb) * (nxt - value)) AS ws FROM cum GROUP BY 1),
devs AS (SELECT "column", greatest(stddev_pop(value), 0.001) AS sd FROM long WHERE ref GROUP BY 1),
scored AS (SELECT *, ks * sqrt(n_reference * n_current / (n_reference + n_current)) AS x, ws / sd AS wn
  FROM drift JOIN devs USING ("column")),
tested AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x))), 0.0), 1.0) END AS p FROM scored),
verdicts AS (SELECT *, CASE WHEN n_reference > 1000 THEN 'wasserstein' ELSE 'ks' END AS method,
  CASE WHEN n_reference > 1000 THEN wn > 0.1 ELSE p < 0.05 END AS drifted FROM tested)"""


def _halves(df):
    return (df.filter(F.col("window_start_ms") < SPLIT_MS),
            df.filter(F.col("window_start_ms") >= SPLIT_MS))


@query(f"""WITH {_SIDES} SELECT "column", n_reference, n_current, {r('ks')} AS ks_statistic, {r('p')} AS ks_p_value,
  {r('ws')} AS wasserstein, {r('wn')} AS wasserstein_normed, method, drifted FROM verdicts""")
def drift_numeric(spark, sf):
    return X.numeric_drift(*_halves(bars(spark, sf)), COLUMNS, exact_rows=0)


@query(f"""WITH RECURSIVE {_SIDES.replace(bars_sql(), bars_sql(DAY))}, paths AS (
  SELECT "column", n_reference AS n, n_current AS m, round(ks * n_reference * n_current) AS apart, 0 AS step,
    list_transform(range(0, n_reference + 1), lambda i: 0.0::DOUBLE) AS out FROM drift
  UNION ALL SELECT "column", n, m, apart, step + 1, list_transform(range(0, n + 1), lambda i:
    CASE WHEN i > step + 1 OR step + 1 - i > m THEN 0.0 WHEN abs(i * m - (step + 1 - i) * n) >= apart THEN 1.0
    ELSE (i * coalesce(out[i], 0.0) + (step + 1 - i) * out[i + 1]) / (step + 1) END) FROM paths WHERE step < n + m)
SELECT "column", n AS n_reference, m AS n_current, {r('ks')} AS ks_statistic, {r('out[n + 1]')} AS ks_p_value,
  out[n + 1] < 0.05 AS drifted FROM paths JOIN drift USING ("column") WHERE step = n + m""")
def drift_daily_exact(spark, sf):
    """Daily candles: few rows, so the exact probability decides."""
    return X.numeric_drift(*_halves(bars(spark, sf, DAY)), COLUMNS).select(
        "column", "n_reference", "n_current", "ks_statistic", "ks_p_value", "drifted")


@query(f"""WITH {_SIDES} SELECT count(*) AS columns, count(*) FILTER (drifted) AS drifted_columns,
  {r('count(*) FILTER (drifted) / count(*)')} AS share, count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift,
  bool_or(drifted) FILTER ("column" = 'close') AS named_column_drift FROM verdicts""")
def drift_share(spark, sf):
    return X.drift_share(X.numeric_drift(*_halves(bars(spark, sf)), COLUMNS, exact_rows=0))


@query(f"""WITH counts AS (SELECT l_returnflag AS value, count(*) FILTER (l_shipdate < TIMESTAMP '1998-01-01') AS a,
  count(*) FILTER (l_shipdate >= TIMESTAMP '1998-01-01') AS b, 'l_returnflag' AS "column" FROM lineitem GROUP BY 1
  UNION ALL SELECT l_linestatus, count(*) FILTER (l_shipdate < TIMESTAMP '1998-01-01'),
  count(*) FILTER (l_shipdate >= TIMESTAMP '1998-01-01'), 'l_linestatus' FROM lineitem GROUP BY 1),
shares AS (SELECT *, sum(a) OVER w AS na, sum(b) OVER w AS nb, a / sum(a) OVER w AS p, b / sum(b) OVER w AS q,
  greatest(a, 0.5) / sum(a) OVER w * sum(b) OVER w AS e FROM counts WINDOW w AS (PARTITION BY "column")),
s AS (SELECT "column", CAST(max(na) AS BIGINT) AS n_reference, CAST(max(nb) AS BIGINT) AS n_current, count(*) AS categories,
  sum((b - e) ** 2 / e) AS chi, sqrt(greatest((sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
  + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS js FROM shares GROUP BY 1)
SELECT "column", n_reference, n_current, categories, {r('chi', 4)} AS chi_square, {r('js')} AS jensen_shannon,
  CASE WHEN n_reference > 1000 THEN 'jensen_shannon' ELSE 'chi_square' END AS method FROM s""")
def drift_categorical(spark, sf):
    items = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return X.categorical_drift(
        items.filter(F.col("l_shipdate") < cut), items.filter(F.col("l_shipdate") >= cut),
        ["l_returnflag", "l_linestatus"]).withColumn("chi_square", F.round("chi_square", 4)).drop(
        "chi_square_p_value", "drifted")


@query()
def drift_categorical_verdict(spark, sf):
    """The chi-square p-value has no SQL twin; tests compare it with tabulated points."""
    items = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return X.categorical_drift(
        items.filter(F.col("l_shipdate") < cut), items.filter(F.col("l_shipdate") >= cut),
        ["l_returnflag", "l_linestatus"]).select("column", "chi_square_p_value", "drifted")


def _forecasts(spark, sf):
    rows = P.add_target(hourly_features(spark, sf), 5, "target", step_ms=HOUR * 1000)
    return forecasts(rows, "target")


@query(f"WITH {FORECASTS} SELECT pair, model, {METRICS}, {r('avg(prediction - actual)')} AS mean_error "
       "FROM forecasts GROUP BY pair, model")
def model_compare(spark, sf):
    return X.compare_models(_forecasts(spark, sf))


def _over_time_sql(by: str, size: int, step: int) -> str:
    size_ms, step_ms = size * _DAY_MS, step * _DAY_MS
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""WITH {FORECASTS}, based AS (SELECT *, min(window_start_ms) OVER ({part}) AS t0,
  max(window_start_ms) OVER ({part}) AS t1 FROM forecasts),
windows AS (SELECT DISTINCT {lead}t0, unnest(range(t0, t1 - {size_ms} + 1, {step_ms})) AS start FROM based)
SELECT {'based.' + by + ' AS ' + by + ', ' if by else ''}start AS window_start_ms, start + {size_ms} AS window_end_ms, {METRICS}
FROM based JOIN windows ON window_start_ms >= start AND window_start_ms < start + {size_ms}
  {f'AND based.{by} = windows.{by}' if by else ''}
GROUP BY {'based.' + by + ', ' if by else ''}start"""


@query(_over_time_sql("", 7, 1))
def error_over_time(spark, sf):
    return X.error_over_time(_forecasts(spark, sf))


@query(_over_time_sql("model", 5, 3))
def error_over_time_by_model(spark, sf):
    return X.error_over_time(_forecasts(spark, sf), 5, 3, by=("model",))


@query(f"""WITH {bars_sql()}, joined AS (
  SELECT a.pair, a.window_start_ms, a.close AS prediction, b.close AS actual FROM bars a
  JOIN bars b ON a.pair = b.pair AND b.window_start_ms = a.window_start_ms + 18000000)
SELECT pair, window_start_ms // {_DAY_MS} * {_DAY_MS} AS bucket_ms, {METRICS},
  avg(abs(actual - prediction)) > 50 AS alarm FROM joined GROUP BY pair, window_start_ms // {_DAY_MS}""")
def prediction_errors(spark, sf):
    rows = bars(spark, sf)
    predicted = rows.select("pair", "window_start_ms", F.col("close").alias("prediction"))
    return X.prediction_errors(predicted, rows, 5 * HOUR * 1000, max_mae=50.0)
