"""Forecast rows used by the report queries: baselines, and a simple point with a band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators import baselines
from meterloom.plans import standin


def forecasts(
    spark: SparkSession,
    sf_dir: str,
    meter: str = "event_type",
    hourly: DataFrame | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Test origins x 24: point = mean of both naive forecasts, band from the last week's spread.

    Pass ``hourly`` where the query reads that table too; its ``carried`` columns are kept.
    """
    rows = baselines.baselines_long(
        standin.hourly(spark, sf_dir, meter, standin.LOAD) if hourly is None else hourly,
        standin.ROLES.target,
        standin.SPLITS.test_start,
        spread=True,
        carried=carried,
    )
    point = (F.col("daily_naive") + F.col("weekly_naive")) / 2
    return rows.withColumns(
        {
            "point": point,
            "lower": point - F.lit(1.645) * F.col("spread"),
            "upper": point + F.lit(1.645) * F.col("spread"),
        }
    )
