"""Long gaps: the training-period (weekday, hour) median profile and filling from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import profile_flag

SLOT = ("dayofweek", "hour_of_day")


def with_slot(hourly: DataFrame) -> DataFrame:
    return hourly.withColumns(
        {"dayofweek": F.weekday("hour"), "hour_of_day": F.hour("hour")}
    )


def seasonal_profile(hourly: DataFrame, columns: Sequence[str], val_start: str) -> DataFrame:
    """Median per meter, weekday and hour over the training hours.

    A group holds one value per training week, so the exact median stays small: the weeks are listed once
    for all columns, which costs less than a median state for each of them.
    """
    train = hourly.filter(F.col("hour") < F.lit(val_start).cast("timestamp_ntz"))
    weeks = with_slot(train).groupBy("meter_id", *SLOT).agg(F.collect_list(F.struct(*columns)).alias("_weeks"))
    return weeks.select("meter_id", *SLOT, *[_median(F.col("_weeks")[c]).alias(f"{c}_profile") for c in columns])


def _median(values: Column) -> Column:
    """Exact, as ``F.median``: the middle value, or the mean of the middle two; nulls don't count."""
    kept = F.array_sort(F.array_compact(values.cast("array<double>")))
    last = F.size(kept) - 1
    low, high = (F.get(kept, f(last / 2).cast("int")) for f in (F.floor, F.ceil))
    return F.when(last >= 0, F.when(last % 2 == 0, low).otherwise(0.5 * low + 0.5 * high))


def join_profile(hourly: DataFrame, profile: DataFrame) -> DataFrame:
    """Left join on the slot. The profile has 168 rows a meter, so the strategy is left to
    Spark, which broadcasts it only below its measured-size threshold."""
    return with_slot(hourly).join(profile, ["meter_id", *SLOT], "left")


def profile_impute(
    hourly: DataFrame, columns: Sequence[str], val_start: str, lacking: Sequence[str] | None = None
) -> DataFrame:
    """Fill nulls from the profile and flag them, all columns in one join.

    Only meters that miss a value need a profile, and only rows that miss one meet it: the others
    are passed on as they are, without a shuffle. ``hourly`` is read several times. A caller that
    has counted the nulls names the columns with any in ``lacking``; the others are flagged only.
    """
    flags = [F.col(c).isNull().cast("int").alias(profile_flag(c)) for c in columns]
    lacking = list(columns) if lacking is None else list(lacking)
    if not lacking:
        return hourly.select("*", *flags)
    missing = reduce(or_, [F.col(c).isNull() for c in lacking])
    whole = hourly.filter(~missing).select("*", *flags)
    meters = hourly.filter(missing).select("meter_id").distinct()
    profile = seasonal_profile(hourly.join(meters, "meter_id", "left_semi"), lacking, val_start)
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}_profile")) for c in lacking}
    mended = join_profile(hourly.filter(missing), profile).select(
        *[filled[c].alias(c) if c in filled else F.col(c) for c in hourly.columns], *flags
    )
    return whole.unionByName(mended)


def missing_counts(hourly: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, as (column, missing) rows."""
    counted = hourly.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "missing")
