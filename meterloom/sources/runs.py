"""Run records: append one per run, read the history, pick the latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("hyperparameters", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("num_features", T.IntegerType()),
        T.StructField("training_time_seconds", T.DoubleType()),
        # method -> metric -> value; older runs may lack a method or a metric
        T.StructField(
            "metrics", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
        ),
    ]
)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.select(*RUN_SCHEMA.fieldNames()).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest record: a running maximum, not a sort."""
    record = F.struct(*runs.columns)
    return runs.agg(F.max_by(record, F.struct("timestamp", "run_id")).alias("r")).select("r.*")


def metrics_long(runs: DataFrame) -> DataFrame:
    """Tidy (run_id, method, metric, value)."""
    by_method = runs.select("run_id", F.explode("metrics").alias("method", "values"))
    return by_method.select("run_id", "method", F.explode("values").alias("metric", "value"))
