"""Functions of columns written in Java, for loops over bytes that neither Spark nor numpy has.

The sources beside this module are compiled on the driver by Janino, with which Spark compiles the
code that it generates, once per application. Executors fetch the classes as any other jar.
"""

from __future__ import annotations

import os
import pkgutil
import tempfile
import zipfile
import zlib
from collections.abc import Callable

from pyspark.sql import Column, SparkSession, functions as F

CLASSES = ("IdBlocks", "TextIds")
_ADDED: set[str] = set()


def _add(spark: SparkSession) -> None:
    if spark.sparkContext.applicationId in _ADDED:
        return
    jar = os.path.join(tempfile.mkdtemp(prefix="tickloom-jar-"), "tickloom.jar")
    with zipfile.ZipFile(jar, "w", zipfile.ZIP_DEFLATED) as packed:
        for name in CLASSES:
            compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
            compiler.cook(pkgutil.get_data(__package__, f"{name}.java").decode())
            made = compiler.getBytecodes()
            for part in made:
                packed.writestr(f"{part.replace('.', '/')}.class", bytes(made[part]))
    spark.sql(f"ADD JAR '{jar}'")
    _ADDED.add(spark.sparkContext.applicationId)


def function(spark: SparkSession, name: str, tables: bytes | None = None) -> Callable[..., Column]:
    """The class `name` as a function of columns that gives bytes; it travels with its tables."""
    _add(spark)
    made = spark._jsparkSession.sharedState().jarClassLoader().loadClass(f"tickloom.{name}").newInstance()
    if tables is not None:
        made.set(tables)
    called = f"tickloom_{name}_{zlib.crc32(tables or b'')}"
    spark._jsparkSession.udf().register(called, made, spark._jvm.org.apache.spark.sql.types.DataTypes.BinaryType)
    return lambda *columns: F.call_udf(called, *columns)
