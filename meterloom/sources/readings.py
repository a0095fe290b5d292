"""Delimited meter readings: scan as text, parse time, coerce numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.config import DATE_TIME_PATTERN, Roles
from meterloom.functions.scalars import to_number


def scan_delimited(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All-text scan of ``;``-separated files with a header; an explicit schema avoids a pass."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, sep=";", header=True, enforceSchema=False)


def parse_event_time(raw: DataFrame, date: str = "Date", time: str = "Time") -> DataFrame:
    """Replace the date and time text by ``ts``; rows whose time does not parse are dropped."""
    text = F.concat_ws(" ", F.col(date), F.col(time))
    parsed = F.try_to_timestamp(text, F.lit(DATE_TIME_PATTERN)).cast("timestamp_ntz")
    return raw.withColumn("ts", parsed).filter(F.col("ts").isNotNull()).drop(date, time)


def coerce_numeric(raw: DataFrame, columns: Sequence[str], type_: str = "float") -> DataFrame:
    return raw.withColumns({c: to_number(F.col(c), type_) for c in columns})


def read_readings(
    spark: SparkSession,
    path: str,
    roles: Roles,
    key_columns: Sequence[str] = (),
    meter_id: str | None = None,
) -> DataFrame:
    """Typed readings (meter_id, ts, row_id, measurements) of delimited files.

    A file without a meter column holds one meter, named by ``meter_id``. ``row_id`` makes the
    order of readings with equal times definite and tells copies apart; it is numbered right on
    the scan, where a task that is run again reads the same split.
    """
    columns = [*key_columns, "Date", "Time", *roles.all_cols]
    raw = scan_delimited(spark, path, columns)
    raw = raw.withColumn("row_id", F.monotonically_increasing_id())
    typed = coerce_numeric(parse_event_time(raw), roles.all_cols)
    if meter_id is not None:
        typed = typed.withColumn("meter_id", F.lit(meter_id))
    return typed.select("meter_id", "ts", "row_id", *roles.all_cols)
