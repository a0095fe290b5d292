"""Scoring many meters at once; a meter that cannot be scored becomes a ``failed`` row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.config import (
    DEEPEST_LAG,
    MIN_HISTORY,
    Roles,
    feature_columns,
    profile_flag,
    short_flag,
)
from meterloom.functions.calendar import epoch_hour, truncate_hour
from meterloom.operators.features import (
    HISTORY_REACH,
    complete_cases,
    downcast,
    feature_frame,
    latest_origin,
    origin_features,
)
from meterloom.operators.model import Forecaster, score_long
from meterloom.sources.requests import forecast_nest

#: Hours before the newest one that scoring looks at; four times what features reach, so that
#: offsets by row still find their rows where hours are missing.
TAIL_HOURS = 4 * HISTORY_REACH


def history_sufficiency(hourly: DataFrame, minimum: int = MIN_HISTORY, key: str = "meter_id") -> DataFrame:
    """(key, hours, status, error): a history needs ``minimum`` distinct hours."""
    short = F.col("hours") < minimum
    reason = F.concat(
        F.lit("history has "), F.col("hours").cast("string"), F.lit(f" of {minimum} hours")
    )
    return (
        hourly.groupBy(key, truncate_hour(F.col("hour")).alias("_h"))
        .agg(F.lit(1))
        .groupBy(key)
        .agg(F.count("_h").alias("hours"))
        .select(key, "hours", F.when(short, "failed").otherwise("ok").alias("status"), F.when(short, reason).alias("error"))
    )


def hourly_history(readings: DataFrame, roles: Roles) -> DataFrame:
    """Request readings as an hourly table: one row per reading, nothing imputed."""
    flags = [f(c) for c in roles.all_cols for f in (short_flag, profile_flag)]
    keys = [c for c in ("request_id", "meter_id") if c in readings.columns]
    return readings.select(
        *keys, F.col("ts").alias("hour"), *roles.all_cols, *[F.lit(0).alias(f) for f in flags]
    )


def tail_of(history: DataFrame, hours: int = TAIL_HOURS) -> DataFrame:
    """The last ``hours`` up to the newest hour of each meter: what its newest features need."""
    newest = history.groupBy("meter_id").agg(F.max("hour").alias("_newest"))
    age = epoch_hour(F.col("_newest")) - epoch_hour(F.col("hour"))
    return history.join(newest, "meter_id").filter(age < hours).drop("_newest")


def latest_features(history: DataFrame, roles: Roles, bounds: DataFrame | None) -> DataFrame:
    """The newest complete feature row of each meter. No later hour is needed.

    Windows see a bounded tail of each history, in one bucket, which keeps offsets by row where
    hours are missing.
    """
    frame = feature_frame(tail_of(history), roles, bounds, with_targets=False, bucket_hours=_ONE_BUCKET)
    return downcast(latest_origin(complete_cases(frame, feature_columns(roles))))


# Longer than any tail.
_ONE_BUCKET = 10**8


def batch_score_meters(
    model: Forecaster, readings: DataFrame, bounds: DataFrame | None = None
) -> DataFrame:
    """(meter_id, forecast_origin_timestamp, predictions, status, error), one row per request.

    Readings with a ``request_id`` are scored request by request, and the result names it; without
    one a meter is a request. Every request has a row: what cannot be scored is ``failed``.
    """
    named = "request_id" in readings.columns
    rows = readings if named else readings.withColumn("request_id", F.col("meter_id"))
    # One row a request: its meter, and its readings with and without a time.
    asked = rows.groupBy("request_id").agg(
        F.max("meter_id").alias("meter_id"),
        F.count("ts").alias("_timed"),
        F.count_if(F.col("ts").isNull()).alias("_untimed"),
    )
    timed = rows.filter(F.col("ts").isNotNull() & F.col("request_id").isNotNull())
    # Requests take the place of meters, so that two requests of one meter stay apart.
    history = hourly_history(timed.drop("meter_id").withColumnRenamed("request_id", "meter_id"), model.roles)
    own = None
    if bounds is not None:
        own = asked.select("request_id", "meter_id").join(bounds, "meter_id").drop("meter_id")
        own = own.withColumnRenamed("request_id", "meter_id")
    checked = history_sufficiency(history)
    scored = forecast_nest(score_long(model, latest_features(history, model.roles, own)))
    as_request = lambda df: df.withColumnRenamed("meter_id", "request_id")
    joined = asked.join(as_request(checked), "request_id", "left").join(as_request(scored), "request_id", "left")
    no_meter, empty = F.col("meter_id").isNull(), F.col("_timed") == 0
    missing = F.col("predictions").isNull()
    error = (
        F.when(no_meter, "request has no meter_id or cannot be read")
        .when(empty & (F.col("_untimed") > 1), F.concat(F.col("_untimed").cast("string"), F.lit(" readings without a valid time")))
        .when(empty, "request has no readings with a valid time")
        .when(F.col("status") == "failed", F.col("error"))
        .when(missing, f"no complete feature row; {DEEPEST_LAG + 1} gap-free hours are needed")
    )
    result = joined.withColumn("error", error)
    failed = F.col("error").isNotNull()
    return result.select(
        *(["request_id"] if named else []),
        "meter_id",
        *[F.when(~failed, F.col(c)).alias(c) for c in ("forecast_origin_timestamp", "predictions")],
        F.when(failed, "failed").otherwise("ok").alias("status"),
        "error",
    )


def score_one_meter(
    model: Forecaster, hourly: DataFrame, meter_id: str, origin: str, bounds: DataFrame | None = None
) -> DataFrame:
    """The 24 forecast rows of one meter at one origin; both filters reach the scan."""
    own = hourly.filter(F.col("meter_id") == meter_id)
    return score_long(model, origin_features(own, model.roles, origin, bounds))
