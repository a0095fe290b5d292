"""Nested scoring requests and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.config import MIN_HISTORY, Roles
from meterloom.functions.calendar import add_hours
from meterloom.functions.scalars import iso_time


def request_schema(roles: Roles) -> T.StructType:
    reading = T.StructType(
        [T.StructField("timestamp", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in roles.all_cols]
    )
    return T.StructType(
        [
            T.StructField("meter_id", T.StringType()),
            T.StructField("history", T.ArrayType(reading)),
        ]
    )


def request_explode(
    requests: DataFrame, roles: Roles, json: str = "request", request_id: str | None = None
) -> DataFrame:
    """One row per reading of each JSON request, time parsed; no request is lost.

    ``request_id`` names the column that tells requests apart; without it the request's text does,
    so that two requests of one meter stay two. A request without readings (malformed, no or an
    empty history) and a reading whose time does not parse keep a row with a null ``ts``.
    """
    key = F.col(request_id).cast("string") if request_id else F.sha2(F.col(json).cast("binary"), 256)
    parsed = requests.select(key.alias("request_id"), F.from_json(json, request_schema(roles)).alias("r"))
    rows = parsed.select("request_id", "r.meter_id", F.explode_outer("r.history").alias("reading"))
    return rows.select(
        "request_id",
        "meter_id",
        F.col("reading.timestamp").try_cast("timestamp_ntz").alias("ts"),
        *[F.col(f"reading.{c}").alias(c) for c in roles.all_cols],
    )


def request_nest(
    hourly: DataFrame, roles: Roles, origin: Column, hours: int = MIN_HISTORY
) -> DataFrame:
    """The last ``hours`` rows up to ``origin`` as one JSON request per meter.

    The hour range bounds each group at ``hours`` entries.
    """
    recent = hourly.filter((F.col("hour") > add_hours(origin, -hours)) & (F.col("hour") <= origin))
    entry = F.struct(
        iso_time(F.col("hour")).alias("timestamp"), *[F.col(c).cast("double").alias(c) for c in roles.all_cols],
    )
    return (
        recent.groupBy("meter_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("history"))
        .select("meter_id", F.to_json(F.struct("meter_id", "history")).alias("request"))
    )


def forecast_nest(scored: DataFrame) -> DataFrame:
    """One nested result row per (meter, origin); each group holds one row per horizon."""
    # --- Fixed values: the keys of a result.
    entry = F.struct(
        F.col("h").alias("horizon_h"),
        F.col("point").alias("point_pred_kw"),
        F.col("lower").alias("lower_bound_90pct_kw"),
        F.col("upper").alias("upper_bound_90pct_kw"),
    )
    return (
        scored.groupBy("meter_id", "origin")
        .agg(F.sort_array(F.collect_list(entry)).alias("predictions"))
        .select(
            "meter_id",
            iso_time(F.col("origin")).alias("forecast_origin_timestamp"),
            "predictions",
        )
    )
