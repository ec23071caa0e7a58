"""Keyed messages, the upserted feature table, replacement and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.operators.dedup import KEYS, latest_per_key, one_per_key
from tickloom.functions.scalars import trading_date
from tickloom.operators.selection import only_models
from tickloom.session import materialize
from tickloom.sources import versions
from tickloom.sources.tables import read_feature_table, read_partitions


def keyed_json(df: DataFrame, key: str = "pair") -> DataFrame:
    """Messages of a keyed topic: key, and the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def from_keyed_json(messages: DataFrame, schema) -> DataFrame:
    """Rows out of the JSON values of a topic."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")


MERGE_AFTER = 16        # folders of a partition from which an upsert merges them into one


def upsert(rows: DataFrame, batch_id: int, path: str, arrival: Column | None = None,
           run: int = 0, merge_after: int = MERGE_AFTER) -> None:
    """Store one batch of feature rows; a later row replaces an earlier one of its key.

    A batch writes a folder of its own, with one file per pair and month that it touches (a
    month of minute candles of a pair is some ten MB), and then adds a version that lists the
    folders of every partition (see `sources.versions`). A partition that has `merge_after`
    folders is written anew as one, so a reader meets a bounded number of folders and, after
    a merge, no row twice. A batch that has been listed already is left out when it is tried
    again; one that has not is overwritten. Batches count from 0 within a `run`; a stream with
    a new checkpoint takes a higher run number. `arrival` orders rows of one key inside a
    batch; without it a batch holds each key once. One writer at a time.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    state = versions.read(spark, path) or {"last": [-1, -1], "partitions": []}
    if [int(run), int(batch_id)] <= state["last"]:
        return
    newest = one_per_key(
        rows.withColumn("_arrival", F.lit(0).cast("bigint") if arrival is None else arrival),
        KEYS["candles"], [F.desc("_arrival")]).drop("_arrival")
    # Stored once: a stream's rows may be expensive, and they are read twice.
    kept = materialize(newest.withColumn("month", F.date_format(trading_date("window_start_ms"), "yyyyMM").cast("int")))
    touched = [(r["pair"], r["month"]) for r in kept.select("pair", "month").distinct().collect()]
    folder, listed = f"run={int(run)}/batch_id={int(batch_id)}", {(p, m): f for p, m, f in state["partitions"]}
    full = [[p, m, listed[p, m]] for p, m in touched if len(listed.get((p, m), ())) + 1 >= merge_after]
    if full:
        before = read_partitions(spark, path, full, state["schema"])
        kept = kept.unionByName(before.join(kept.select(*KEYS["candles"]), KEYS["candles"], "left_anti"), allowMissingColumns=True)
    kept.repartition("pair", "month").write.mode("overwrite").partitionBy("pair", "month").parquet(f"{path}/{folder}")
    merged = {(p, m) for p, m, _ in full}
    for key in touched:
        listed[key] = [folder] if key in merged else [*listed.get(key, []), folder]
    versions.write(spark, path, {
        "last": [int(run), int(batch_id)], "schema": kept.schema.jsonValue(),
        "partitions": [[p, m, folders] for (p, m), folders in sorted(listed.items())]})


def compact(spark: SparkSession, path: str, new_path: str) -> None:
    """Write the current rows of a feature table as a single batch of a new one.

    Readers and the stream switch to it afterwards, the stream with a higher run number.
    """
    upsert(read_feature_table(spark, path), 0, new_path)


def replace_with_clean_copy(df: DataFrame, path: str, key: list[str] = KEYS["candles"],
                            created: str = "created_at", arrival: str = "seq") -> None:
    """Write the de-duplicated rows to a new path; readers switch when it is complete."""
    latest_per_key(df, key, created, arrival).drop(arrival).write.mode("errorifexists").parquet(path)


def swap(spark: SparkSession, new_path: str, path: str, old_path: str) -> None:
    """Put the finished copy at `new_path` in the place of `path`; the old table moves to `old_path`."""
    def place(name: str):
        return spark._jvm.org.apache.hadoop.fs.Path(name)

    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place(f"{new_path}/_SUCCESS")):
        raise ValueError(f"{new_path} is not complete")
    if files.exists(place(old_path)) or not files.rename(place(path), place(old_path)):
        raise RuntimeError(f"{path} cannot move to {old_path}")
    if not files.rename(place(new_path), place(path)):
        files.rename(place(old_path), place(path))
        raise RuntimeError(f"{new_path} cannot move to {path}; the old table is back")


def sample(df: DataFrame, n: int = 100, order: str = "window_start_ms") -> DataFrame:
    """The first n rows in time order, for a look at the data."""
    return df.orderBy(order, "pair").limit(n)


def export_sample(df: DataFrame, path: str, n: int = 100) -> None:
    sample(df, n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_comparison(board: DataFrame, top: DataFrame, path: str) -> None:
    """Write the full comparison as CSV and JSON, and the best models as CSV."""
    board.write.mode("overwrite").option("header", True).csv(f"{path}/models_comparison_csv")
    board.write.mode("overwrite").json(f"{path}/models_comparison_json")
    only_models(board, top).write.mode("overwrite").option("header", True).csv(f"{path}/top_models_csv")
