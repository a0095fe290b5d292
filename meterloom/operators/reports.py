"""Report tables: histograms, forecast detail, context, rankings, origin selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.config import HISTOGRAM_BINS, HORIZON, TOP_FEATURES
from meterloom.functions.calendar import add_hours
from meterloom.functions.scalars import horizon_label, minute_time


def time_slice(table: DataFrame, start: Column, end: Column, time: str = "hour") -> DataFrame:
    """Inclusive time range; on a Parquet table it is pushed to the scan."""
    return table.filter(F.col(time).between(start, end))


def residual_histogram(residuals: DataFrame, e: str = "residual", bins: int = HISTOGRAM_BINS):
    """Equal-width bins over [min, max] as density; the last bin includes its right edge.

    Two passes: a one-row range (a scalar subquery), then a partial-aggregated count per bin.
    """
    extent = residuals.agg(F.min(e).alias("lo"), F.max(e).alias("hi"), F.count(e).alias("n"))
    span = extent.select(F.struct("lo", "hi", "n")).scalar()
    low, width = span["lo"], (span["hi"] - span["lo"]) / bins
    place = F.least(F.floor((F.col(e) - low) / width), F.lit(bins - 1)).cast("int")
    counted = residuals.groupBy(F.when(width == 0, 0).otherwise(place).alias("bin")).agg(
        F.count(e).alias("n_bin")
    )
    edges = extent.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / bins
    left = F.col("lo") + step * F.col("bin")
    count = F.coalesce("n_bin", F.lit(0))
    return edges.join(counted, "bin", "left").select(
        "bin",
        left.alias("left_edge"),
        (left + step).alias("right_edge"),
        count.alias("count"),
        F.try_divide(count, F.col("n") * step).alias("density"),
    )


def residual_normal_fit(residuals: DataFrame, e: str = "residual", bins: int = HISTOGRAM_BINS):
    """Mean, population deviation and the normal density at each of the bins + 1 edges."""
    fit = residuals.agg(
        F.avg(e).alias("mu"), F.stddev_pop(e).alias("sigma"), F.min(e).alias("_lo"), F.max(e).alias("_hi")
    )
    at = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("edge"))
    x = F.col("_lo") + (F.col("_hi") - F.col("_lo")) / bins * F.col("edge")
    z = (x - F.col("mu")) / F.col("sigma")
    density = F.exp(-z * z / 2) / (F.col("sigma") * math.sqrt(2 * math.pi))
    return at.select("edge", x.alias("x"), "mu", "sigma", density.alias("density"))


def forecast_vs_actual(long: DataFrame, start: Column, end: Column) -> DataFrame:
    """One-step-ahead actual, point, band and daily naive for origins in a period."""
    return (
        time_slice(long, start, end, "origin")
        .filter(F.col("h") == 1)
        .select("meter_id", "origin", "actual", "point", "lower", "upper", "daily_naive")
    )


def forecast_detail(long: DataFrame, origin: Column) -> DataFrame:
    """The 24 rows of one forecast origin."""
    rows = long.filter(F.col("origin") == origin)
    return rows.select(
        "meter_id",
        "h",
        horizon_label(F.col("h")).alias("horizon"),
        minute_time(F.col("target_time")).alias("timestamp"),
        "lower",
        "point",
        "upper",
        "actual",
        (F.col("actual") - F.col("point")).alias("error"),
    ).orderBy("meter_id", "h")


def history_context(hourly: DataFrame, long: DataFrame, target: str, origin: Column) -> DataFrame:
    """Last 24 hours up to the origin and the forecast after it, tagged by series, with the
    largest value of both per meter (the plot's ceiling)."""
    past = time_slice(hourly, add_hours(origin, -(HORIZON - 1)), origin).select(
        "meter_id", F.lit("history").alias("series"), F.col("hour").alias("time"), F.col(target).alias("value")
    )
    ahead = long.filter(F.col("origin") == origin).select(
        "meter_id",
        F.lit("forecast").alias("series"),
        F.col("target_time").alias("time"),
        F.col("point").alias("value"),
    )
    both = past.unionByName(ahead)
    # 48 rows a meter: one for each hour on either side of the origin.
    ceiling = both.groupBy("meter_id").agg(F.max("value").alias("ceiling"))
    return both.join(ceiling, "meter_id")


def top_k(table: DataFrame, value: str, name: str, k: int = TOP_FEATURES) -> DataFrame:
    return table.orderBy(F.desc(value), F.asc(name)).limit(k)


def mean_importance(importances: Sequence[DataFrame]) -> DataFrame:
    """(feature, mean_importance) over several (feature, importance) tables.

    A union and one average equal an outer join per table with nulls skipped.
    """
    rows = importances[0]
    for more in importances[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))


def join_outer_importance(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two importance tables side by side; the mean skips what a table lacks."""
    joined = left.withColumnRenamed("importance", "importance_left").join(
        right.withColumnRenamed("importance", "importance_right"), "feature", "full"
    )
    total = F.coalesce("importance_left", F.lit(0.0)) + F.coalesce("importance_right", F.lit(0.0))
    present = F.col("importance_left").isNotNull().cast("int") + F.col(
        "importance_right"
    ).isNotNull().cast("int")
    return joined.withColumn("mean_importance", total / present)


def origin_range(hourly: DataFrame, test_start: str, by: Sequence[str] = ("meter_id",)) -> DataFrame:
    """First and last selectable test origin; the last leaves a full horizon after it."""
    test = hourly.filter(F.col("hour") >= F.lit(test_start).cast("timestamp_ntz"))
    return (
        test.groupBy(*by)
        .agg(F.min("hour").alias("first_origin"), F.max("hour").alias("_last"))
        .select(*by, "first_origin", add_hours(F.col("_last"), -HORIZON).alias("last_origin"))
    )


def sample_origin(hourly: DataFrame, test_start: str, seed: str, spare_hours: int = 48) -> DataFrame:
    """One pseudo-random test hour, the same for the same seed, keeping ``spare_hours`` free.

    Ordering by a hash of (seed, hour) makes it a top-1, not a shuffle-and-pick.
    """
    test = hourly.filter(F.col("hour") >= F.lit(test_start).cast("timestamp_ntz"))
    end = test.agg(F.max("hour")).scalar()
    draw = F.md5(F.concat(F.lit(seed), F.replace(F.replace(F.substring(F.col("hour").cast("string"), 1, 13), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))))
    candidates = test.select("hour").filter(F.col("hour") <= add_hours(end, -spare_hours))
    return candidates.orderBy(draw, "hour").limit(1)
