"""Baseline forecasts: same hour yesterday, same hour last week, mean of the last 7 days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import HORIZON, LONG_WINDOW
from meterloom.functions.calendar import add_hours
from meterloom.operators.chunks import core_rows, halo_buckets
from meterloom.operators.features import (
    BUCKET_HOURS,
    Rolling,
    lag_of,
    lead_of,
    rolling,
    with_rolling,
)

BASELINES = ("daily_naive", "weekly_naive", "rolling_avg_7d")


def _shifted(c: str, hours_ahead: int) -> Column:
    """The value ``hours_ahead`` of the row; behind it when negative."""
    if hours_ahead > 0:
        return lead_of(c, hours_ahead)
    return lag_of(c, -hours_ahead) if hours_ahead else F.col(c)


def baselines_long(
    hourly: DataFrame,
    target: str,
    origins_from: str | None = None,
    spread: bool = False,
    bucket_hours: int = BUCKET_HOURS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """(meter_id, origin, h, target_time, actual, three baselines) for complete origins.

    Forecasts are read off the origin's own row by window offsets in one pass and then
    unfolded; nothing is joined. ``spread`` adds the standard deviation of the same 168 hours;
    ``carried`` columns of the origin's hour are kept.
    """
    series = hourly.select("meter_id", "hour", target, *carried)
    if origins_from is not None:
        start = F.lit(origins_from).cast("timestamp_ntz")
        series = series.filter(F.col("hour") >= add_hours(start, -LONG_WINDOW))
    bucketed = halo_buckets(series, bucket_hours, LONG_WINDOW, HORIZON)
    statistics = [Rolling("rolling_avg_7d", "mean", target, LONG_WINDOW)]
    if spread:
        statistics.append(Rolling("spread", "std", target, LONG_WINDOW))
    extra = [*[s.name for s in statistics], *carried]
    # A day from each row on, as quarters that are built once; the three series are that day at other rows. Complete
    # origins have all the rows before them, and the hours ahead, so what lacks one is null and filtered below.
    quarter = HORIZON // 4
    days = (
        with_rolling(bucketed, statistics, through_now=True)
        .withColumn("_quarter", F.array(*[_shifted(target, k) for k in range(quarter)]))
        .withColumn("_day", F.concat(*[_shifted("_quarter", k * quarter) for k in range(4)]))
    )
    full = days.withColumns({"_actual": _shifted("_day", 1), "_daily": _shifted("_day", -23), "_weekly": _shifted("_day", -167)})
    rows = core_rows(full)
    if origins_from is not None:
        rows = rows.filter(F.col("hour") >= start)
    complete = rows.filter(
        F.col("rolling_avg_7d").isNotNull() & F.forall("_actual", lambda v: v.isNotNull())
    )
    steps_of = F.posexplode(F.arrays_zip("_actual", "_daily", "_weekly")).alias("_p", "_v")
    return complete.select(
        "meter_id", F.col("hour").alias("origin"), *extra, steps_of
    ).select(
        "meter_id",
        "origin",
        (F.col("_p") + 1).alias("h"),
        add_hours(F.col("origin"), F.col("_p") + 1).alias("target_time"),
        F.col("_v._actual").alias("actual"),
        F.col("_v._daily").alias("daily_naive"),
        F.col("_v._weekly").alias("weekly_naive"),
        *extra,
    )


def naive_at(hourly: DataFrame, target: str, hours_back: int, name: str) -> DataFrame:
    """Naive forecast per target hour (every origin of that hour shares it)."""
    bucketed = halo_buckets(hourly.select("meter_id", "hour", target), BUCKET_HOURS, hours_back)
    return core_rows(bucketed.withColumn(name, lag_of(target, hours_back)))


def rolling_average(hourly: DataFrame, target: str) -> DataFrame:
    """Mean of the last 168 hours including the origin; null until they exist."""
    statistic = Rolling("rolling_avg_7d", "mean", target, LONG_WINDOW)
    return rolling(hourly.select("meter_id", "hour", target), [statistic], through_now=True)
