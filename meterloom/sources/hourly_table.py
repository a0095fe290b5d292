"""The hourly table as a read-through Parquet cache, partitioned by month for time pruning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def write_hourly(hourly: DataFrame, path: str) -> None:
    """One directory per month; rows are clustered first so that each month has few files."""
    dated = hourly.withColumn("month", F.substring(F.col("hour").cast("string"), 1, 7))
    # Rebalancing lets adaptive execution split a month that outgrows one task.
    ordered = dated.hint("rebalance", "month").sortWithinPartitions("month", "meter_id", "hour")
    ordered.write.mode("overwrite").partitionBy("month").parquet(path)


def hourly_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path``, building and writing it first when it is not complete."""
    if not _exists(spark, path):
        write_hourly(build(), path)
    return spark.read.parquet(path).drop("month")


def hourly_between(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The hours from ``first`` to ``last`` (inclusive) of a stored table; other months are not opened."""
    table = spark.read.parquet(path)
    for bound, within in ((first, lambda c, b: c >= b), (last, lambda c, b: c <= b)):
        if bound is not None:
            at = F.lit(bound).cast("timestamp_ntz")
            month = F.lit(str(bound)[:7])
            table = table.filter(within(F.col("hour"), at) & within(F.substring(F.col("month").cast("string"), 1, 7), month))
    return table.drop("month")
