"""Scoring by a table of model parameters: every row by the newest version of its pair's model.

The table holds one row per registered version: linear coefficients or boosted trees, with the
features in their order. Scoring joins the newest versions to the rows (broadcast while they are
small) and evaluates either kind as an expression, so any number of pairs is one plan, for a
table or a stream. A pair without a model gets the baseline: the price stays.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tickloom.functions.lookups import attach
from tickloom.operators.boosting import TREE, _known, boosted_value
from tickloom.session import materialize, temporary

PARAMETERS = T.StructType([
    T.StructField("pair", T.StringType()), T.StructField("model", T.StringType()), T.StructField("horizon", T.IntegerType()),
    T.StructField("version", T.IntegerType()), T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("base", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())), T.StructField("trees", TREE)])


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    """The table of parameters at `path` as it is now; empty if there is none yet."""
    try:
        return spark.read.schema(PARAMETERS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PARAMETERS)


def newest(parameters: DataFrame, horizon: int) -> DataFrame:
    """One row per pair: the highest version for the horizon; of equal versions the last model name."""
    order = Window.partitionBy("pair").orderBy(F.desc("version"), F.desc("model"))
    return parameters.filter(F.col("horizon") == horizon).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def register_parameters(models: DataFrame, path: str, features: list[str], horizon: int) -> DataFrame:
    """Append models (pair, model and intercept with coefficients, or base with trees) as the next version of their pair.

    Returns the rows that were added. Versions count per pair and horizon, so the newest is the
    one that scores, whatever its family.
    """
    spark = models.sparkSession
    known = read_parameters(spark, path).filter(F.col("horizon") == horizon).groupBy("pair").agg(F.max("version").alias("_have"))

    def column(name: str, kind: str) -> Column:
        return F.col(name) if name in models.columns else F.lit(None).cast(kind)

    rows = models.select(
        "pair", "model", F.lit(horizon).cast("int").alias("horizon"), F.array(*map(F.lit, features)).alias("features"),
        F.coalesce(column("base", "double"), column("intercept", "double")).alias("base"),
        column("coefficients", "array<double>").alias("coefficients"), column("trees", TREE.simpleString()).alias("trees"))
    made = attach(rows, known, ["pair"]).withColumn("version", (F.coalesce("_have", F.lit(0)) + 1).cast("int"))
    made = materialize(made.select(*PARAMETERS.names))
    made.write.mode("append").parquet(path)
    return made


def score_rows(rows: DataFrame, parameters: DataFrame, features: list[str], horizon: int) -> DataFrame:
    """The rows with model, version and prediction.

    `features` are those that any model may use; a model finds its own by name. A row in which a
    linear model misses a value gets the baseline (model NULL), as does a pair without a model.
    """
    now = materialize(newest(parameters, horizon).drop("horizon"))
    size = now.agg(F.max(F.coalesce(F.aggregate("trees", F.lit(0), lambda n, t: n + F.size(t["value"])), F.lit(0)))).first()[0] or 0
    renamed = now.select("pair", *[F.col(c).alias(f"_{c}") for c in now.columns if c != "pair"])
    wide = attach(rows, renamed, ["pair"], "left", row_bytes=32 * (size + 1) + 64 * (len(features) + 4), stored=True)
    # Values in the order that the model names its features.
    names, values = F.array(*map(F.lit, features)), F.array(*[_known(c) for c in features])
    x = F.transform("_features", lambda name: F.get(values, (F.array_position(names, name) - 1).cast("int")))
    linear = F.aggregate(F.zip_with(x, F.col("_coefficients"), lambda a, b: a * b), F.col("_base"), lambda s, v: s + v)
    found = F.when(F.col("_coefficients").isNotNull(), linear).when(
        F.col("_trees").isNotNull(), boosted_value(x, F.col("_base"), F.col("_trees")))
    made = wide.withColumn("prediction", F.coalesce(found, F.col("close")))
    used = found.isNotNull()
    return made.withColumns({"model": F.when(used, F.col("_model")), "version": F.when(used, F.col("_version"))}).select(
        *[c for c in rows.columns if c not in ("model", "version", "prediction")], "model", "version", "prediction")


def scoring_stream(rows: DataFrame, parameters_path: str, features: list[str], horizon: int, path: str, checkpoint: str):
    """Writer that scores each micro-batch with the parameters as they are when it starts, into a folder per batch.

    A version registered while the stream runs scores from the next micro-batch on. A batch
    that is done again replaces its own folder (`batch=n`).
    """
    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with temporary(spark):
            made = score_rows(batch, read_parameters(spark, parameters_path), features, horizon)
            made.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(score)
