"""Which folders hold the current rows of each partition of a feature table.

A small JSON list per version below `_versions`; the newest one counts. Writers add a version
in one step (a rename), so readers see all of a batch or nothing of it.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

FOLDER = "_versions"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, place = _place(spark, f"{path}/{FOLDER}")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read(spark: SparkSession, path: str) -> dict | None:
    """The newest version: schema, the last batch, and [pair, month, folders] per partition."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    files, place = _place(spark, f"{path}/{FOLDER}/{numbers[-1]}.json")
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write(spark: SparkSession, path: str, version: dict, keep: int = 2) -> None:
    """Add a version; of the older lists the newest `keep` stay for readers that have begun."""
    numbers = _numbers(spark, path)
    name = f"{path}/{FOLDER}/{(numbers[-1] if numbers else 0) + 1}.json"
    files, target = _place(spark, name)
    _, draft = _place(spark, f"{path}/{FOLDER}/.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(version).encode()))
    out.close()
    if not files.rename(draft, target):
        raise RuntimeError(f"another writer has added {name}")
    for number in numbers[:-keep]:
        files.delete(_place(spark, f"{path}/{FOLDER}/{number}.json")[1], False)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete batch folders that no kept version names; returns them. Run it between readers."""
    named = set()
    for number in _numbers(spark, path):
        files, place = _place(spark, f"{path}/{FOLDER}/{number}.json")
        stream = files.open(place)
        version = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        named |= {f for *_, folders in version["partitions"] for f in folders}
    files, top = _place(spark, path)
    gone = []
    for run in files.listStatus(top):
        if run.getPath().getName().startswith("run="):
            for batch in files.listStatus(run.getPath()):
                name = f"{run.getPath().getName()}/{batch.getPath().getName()}"
                if name not in named:
                    files.delete(batch.getPath(), True)
                    gone.append(name)
    return gone


def partition_path(spark: SparkSession, path: str, folder: str, pair: str, month: int) -> str:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(pair)
    return f"{path}/{folder}/pair={escaped}/month={month}"
