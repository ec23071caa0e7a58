"""Session settings and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; `conf` overrides the defaults.

    Partition numbers are left to the cluster's own settings.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once per application; returns the session.

    Functions that run in Python workers are found by their module's name, so a worker needs
    the package even where it is not installed. The driver serves the archive itself.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="tickloom-code-"), "tickloom.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        packed.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(archive)
        # Workers that stand beside the driver (stateful streams) get no files, but its paths.
        paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        context.environment["PYTHONPATH"] = os.pathsep.join([*paths, os.path.dirname(top)])
        _SHIPPED.add(context.applicationId)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster for intermediate results (spark.checkpoint.dir).

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one."""
    return f"{checkpoint_folder(spark).rstrip('/')}/tickloom-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession):
    """Delete, at its end, what `materialize` has stored inside it (but for `keep`).

    Results that are still needed have to be stored with keep=True, or written, before.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(stored: DataFrame) -> None:
    """Delete what `materialize` has stored for this very result, when a loop has replaced it."""
    _delete(stored.sparkSession, stored._stored_at)


def materialize(df: DataFrame, by: str | None = None, spread: Column | None = None,
                keep: bool = False) -> DataFrame:
    """Compute `df` once, as a Parquet table in the shared folder, and return that table.

    For results that several later steps read: each reads only the columns it needs, Spark
    knows the size, and losing an executor costs no recomputation. With `by` every value of
    that column gets a directory of its own, for steps that read one value at a time;
    `spread` splits large values over several tasks and files. Inside `temporary` the table
    goes when that ends, unless it is to be kept.
    """
    path = work_folder(df.sparkSession)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    if by:
        # Empty tables leave no directory behind, so the schema is given on reading.
        parts = [by] if spread is None else [by, spread]
        df.repartition(*parts).write.partitionBy(by).parquet(path)
    else:
        df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    made._stored_at = path
    return made
