"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs twice to warm up; the median of BENCH_RUNS (default 3) further runs counts,
including all jobs that building the query starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.catalog.base import bars, supplier_trades, trades  # noqa: E402
from tickloom.operators import (  # noqa: E402
    candles as C, dedup as D, drift as X, models as M, prep as P, quality as Q, splits as L)
from tickloom.operators.indicators import indicators  # noqa: E402
from tickloom.plans.features import feature_table  # noqa: E402
from tickloom.session import build_session, work_folder  # noqa: E402
from tickloom.sinks.tables import upsert  # noqa: E402
from tickloom.sources.tables import read_feature_table  # noqa: E402

MINUTE_MS = 60_000
COLUMNS = ["open", "high", "low", "close", "volume"]


def headline(spark, sf: str):
    from pyspark.sql import functions as F

    def minute_bars():
        return bars(spark, sf, 60)

    def drift():
        rows = minute_bars()
        cut = F.col("window_start_ms") < 1_705_363_200_000
        return X.numeric_drift(rows.filter(cut), rows.filter(~cut), COLUMNS)

    def upserted():
        """Five batches that touch every month, and the table read back."""
        rows, path = minute_bars(), f"{work_folder(spark)}/table"
        for day in range(5):
            upsert(rows.filter(F.expr(f"window_start_ms div 86400000 % 5 = {day}")), day, path)
        return read_feature_table(spark, path)

    def linear():
        rows = P.add_target(minute_bars(), 5, "target")
        return M.predict_linear(M.fit_linear(rows, COLUMNS, "target"), rows, COLUMNS, "target")

    return {
        "linear_models": linear,
        "upsert_5_batches": upserted,
        "candles_60s": lambda: C.candles(trades(spark, sf), 60),
        "candles_daily_supplier": lambda: C.candles(supplier_trades(spark, sf), 86_400),
        "candles_rollup": lambda: C.roll_up(C.candles(trades(spark, sf), 60), 3600),
        "candles_filled_60s": lambda: C.fill_gaps(minute_bars(), 60),
        "sma_rsi_macd_tail": lambda: indicators(minute_bars(), kinds=("sma", "rsi", "macd", "macdsignal", "macdhist")),
        "all_indicators_tail": lambda: indicators(minute_bars()),
        "ema_full": lambda: indicators(minute_bars(), seed="full", kinds=("ema",)),
        "feature_table_60s": lambda: feature_table(trades(spark, sf), 60, max_history=60),
        "dedup_first": lambda: D.dedup(trades(spark, sf), "trades"),
        "dedup_supplier": lambda: D.dedup(supplier_trades(spark, sf), "trades"),
        "duplicate_report": lambda: D.duplicate_report(supplier_trades(spark, sf), D.KEYS["trades"]),
        "feed_gaps": lambda: Q.feed_gaps(trades(spark, sf)),
        "fill_interpolate": lambda: P.fill_missing(minute_bars().withColumn(
            "close", F.when(F.col("close") >= 25, F.col("close"))), "interpolate", ["close"]),
        "target_lead": lambda: P.add_target(minute_bars(), 5),
        "scale_standard": lambda: (lambda rows: P.apply_scaler(rows, P.fit_scaler(rows)))(minute_bars()),
        "scale_robust": lambda: (lambda rows: P.apply_scaler(rows, P.fit_scaler(rows, kind="robust")))(minute_bars()),
        "split_tvt": lambda: L.split_train_validation_test(minute_bars()),
        "profile_columns": lambda: Q.profile(minute_bars(), COLUMNS),
        "drift_numeric": drift,
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def once(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name, build in headline(spark, sf).items():
        once(build)
        once(build)
        times[name] = round(statistics.median(once(build) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
