"""Readings to a gap-free hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import Roles, short_flag
from meterloom.functions.calendar import truncate_hour


def meter_bounds(readings: DataFrame) -> DataFrame:
    """First and last hour of each meter; reads two columns, combines before the shuffle."""
    return (
        readings.groupBy("meter_id")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
        .select(
            "meter_id",
            truncate_hour(F.col("first")).alias("first_hour"),
            truncate_hour(F.col("last")).alias("last_hour"),
        )
    )


def hourly_spine(bounds: DataFrame) -> DataFrame:
    """Every hour between a meter's first and last reading.

    The bounds are a small table that unfolds into the largest one, so it is unfolded to months
    first and spread over all shuffle partitions (an explicit number, which adaptive execution
    does not merge). Going through months also keeps the arrays short when a stray timestamp
    lies far off.
    """
    return _months(bounds).select("meter_id", F.explode(_hours("_start", "_end")).alias("hour"))


def _months(bounds: DataFrame) -> DataFrame:
    """(meter_id, _month, _start, _end): the part of each month that lies between a meter's bounds."""
    tasks = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, last = F.col("first_hour"), F.col("last_hour")
    month = F.explode(
        F.sequence(
            F.trunc(first, "month"), F.trunc(last, "month"), F.make_ym_interval(months=F.lit(1))
        )
    )
    months = bounds.select("meter_id", "first_hour", "last_hour", month.alias("_month"))
    start = F.greatest(first, F.col("_month").cast("timestamp_ntz"))
    end = F.least(last, F.add_months("_month", 1).cast("timestamp_ntz") - _hour())
    return months.repartition(tasks, "meter_id", "_month").select(
        "meter_id", "_month", start.alias("_start"), end.alias("_end")
    )


def _hour() -> Column:
    return F.make_dt_interval(hours=F.lit(1))


def _hours(first: str, last: str) -> Column:
    return F.sequence(first, last, _hour())


def _hourly(readings: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    keyed = readings.withColumn("hour", truncate_hour(F.col("ts")))
    return keyed.groupBy("meter_id", "hour").agg(*aggregates)


def _on_spine(readings, aggregates: Sequence[Column], bounds: DataFrame | None):
    """The aggregates of every hour between the bounds; null where an hour has no reading.

    Hours with readings meet the months of their meter, and each unfolds into itself and the empty
    hours up to the next one. So the spine, which may be many times longer, is neither shuffled,
    sorted nor joined. A month's first hour opens it where no earlier reading does.
    """
    months = _months(meter_bounds(readings) if bounds is None else bounds)
    hours = _hourly(readings, aggregates)
    values = [c for c in hours.columns if c not in ("meter_id", "hour")]
    keyed = hours.withColumn("_month", F.trunc("hour", "month"))
    # A month without readings, and a meter that is null, keeps its hours: they are empty.
    met = months.join(
        keyed.withColumnRenamed("meter_id", "_meter"),
        (months["meter_id"] == F.col("_meter"))
        & (months["_month"] == keyed["_month"])
        & F.col("hour").between(F.col("_start"), F.col("_end")),
        "left",
    ).select("meter_id", months["_month"], "_start", "_end", "hour", *values)
    series = Window.partitionBy("meter_id", "_month", "_start").orderBy("hour")
    opened = F.when(F.lag("hour").over(series).isNull(), F.col("_start")).otherwise(F.col("hour"))
    until = F.coalesce(F.lead("hour").over(series) - _hour(), F.col("_end"))
    unfolded = met.withColumns({"_first": opened, "_last": until}).select(
        "meter_id", "hour", F.explode(_hours("_first", "_last")).alias("_at"), *values
    )
    read = F.col("_at") == F.col("hour")
    return unfolded.select(
        "meter_id", F.col("_at").alias("hour"), *[F.when(read, F.col(c)).alias(c) for c in values]
    )


def resample_sum(
    readings: DataFrame,
    columns: Sequence[str],
    empty_sum: str = "zero",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Hourly sums; an hour without a valid reading is 0 (``zero``) or stays null (``null``)."""
    summed = _on_spine(readings, [F.sum(c).alias(c) for c in columns], bounds)
    return summed.select("meter_id", "hour", *[_empty(c, empty_sum).alias(c) for c in columns])


def resample_mean(
    readings: DataFrame, columns: Sequence[str], bounds: DataFrame | None = None
) -> DataFrame:
    return _on_spine(readings, [F.avg(c).alias(c) for c in columns], bounds)


def resample_max_flag(
    readings: DataFrame, flags: Sequence[str], bounds: DataFrame | None = None
) -> DataFrame:
    """An hour is flagged when any of its readings is; an absent hour is not."""
    flagged = _on_spine(readings, [F.max(c).alias(c) for c in flags], bounds)
    return flagged.fillna(0, list(flags))


def _empty(column: str, empty_sum: str) -> Column:
    if empty_sum not in ("zero", "null"):
        raise ValueError(f"empty_sum is 'zero' or 'null', not {empty_sum!r}")
    return F.coalesce(F.col(column), F.lit(0.0)) if empty_sum == "zero" else F.col(column)


def resample_hourly(
    filled: DataFrame, roles: Roles, empty_sum: str = "zero", bounds: DataFrame | None = None
) -> DataFrame:
    """Sums, means and short-gap flags of all columns in one aggregate.

    Pass ``bounds`` of the raw readings so that the spine does not replay the gap fill.
    """
    flags = [short_flag(c) for c in roles.all_cols]
    sums = [F.sum(F.col(c).cast("double")).alias(c) for c in roles.sum_cols]
    means = [F.avg(c).alias(c) for c in roles.mean_cols]
    maxima = [F.max(f).alias(f) for f in flags]
    table = _on_spine(filled, [*sums, *means, *maxima], bounds)
    values = [
        _empty(c, empty_sum).alias(c) if c in roles.sum_cols else F.col(c) for c in roles.all_cols
    ]
    return table.select(
        "meter_id", "hour", *values, *[F.coalesce(f, F.lit(0)).alias(f) for f in flags]
    )
