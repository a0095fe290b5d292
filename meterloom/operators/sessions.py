"""Sessions: stretches of a meter's readings without a pause longer than the meter's gap, in batch and in a stream.

A session ends a gap after its last reading. The gap may differ from meter to meter (a column of the readings). In a
stream a late reading within the watermark may join two sessions into one; sessions are given out once the watermark
has passed their end. Readings without a meter, a time or a positive gap are left out. Zone-free times are taken as they are in batch and read in the
session zone in a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reading_sessions(readings: DataFrame, gap_seconds: str, lateness: str | None = None) -> DataFrame:
    """meter_id, start, stop (a gap after the last reading), readings; ``gap_seconds`` names a column.

    ``lateness`` is the watermark of a stream.
    """
    placed = readings.where(F.col("meter_id").isNotNull() & F.col("ts").isNotNull() & (F.col(gap_seconds) > 0))
    if readings.isStreaming:
        if lateness is None:
            raise ValueError("a stream needs a lateness")
        placed = placed.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    gap = F.concat(F.col(gap_seconds).cast("string"), F.lit(" seconds"))
    grouped = placed.groupBy("meter_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("readings"))
    return grouped.select(
        "meter_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("stop"), "readings"
    )
