"""The hourly SUM / MEAN aggregate of a stream of readings.

Same aggregates as the batch resample, per tumbling hour. Hours without readings are not
emitted: the spine and the gap fills need the rows around a gap and stay in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.config import Roles


def hourly_stream(readings: DataFrame, roles: Roles, lateness: str = "2 hours") -> DataFrame:
    """(meter_id, hour, columns); an hour closes once the watermark passes its end.

    ``ts`` may be zone-free; event time needs an instant, so it is read in the session zone.
    """
    timed = readings.withColumn("ts", F.col("ts").cast("timestamp"))
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in roles.sum_cols]
    means = [F.avg(c).alias(c) for c in roles.mean_cols]
    return (
        timed.withWatermark("ts", lateness)
        .groupBy("meter_id", F.window("ts", "1 hour").alias("w"))
        .agg(*sums, *means)
        .select(
            "meter_id",
            F.col("w.start").cast("timestamp_ntz").alias("hour"),
            *roles.all_cols,
        )
    )
