"""Guards, labels and error terms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.config import ZERO_DENOMINATOR

# --- Fixed values -----------------------------------------------------------
LOW_LOAD = "Low-Load (<=Median)"
HIGH_LOAD = "High-Load (>Median)"
# ----------------------------------------------------------------------------
#: Of a meter without training rows, or an hour without a value.
UNKNOWN_LOAD = "Unknown-Load"


def to_number(text: Column, type_: str = "float") -> Column:
    """Text to number; garbage, blanks, '?' and NaN become NULL."""
    number = F.trim(text).try_cast(type_)
    return F.when(~F.isnan(number), number)


def split_label(ts: Column, val_start: str, test_start: str) -> Column:
    return (
        F.when(ts < F.lit(val_start).cast("timestamp_ntz"), "train")
        .when(ts < F.lit(test_start).cast("timestamp_ntz"), "val")
        .otherwise("test")
    )


def clip(value: Column, low: Column, high: Column) -> Column:
    """Null stays null; greatest/least alone would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def safe_denominator(value: Column) -> Column:
    return F.when(value == 0, F.lit(ZERO_DENOMINATOR)).otherwise(value)


def load_level(value: Column, median: Column) -> Column:
    return F.when(value <= median, LOW_LOAD).when(value > median, HIGH_LOAD).otherwise(UNKNOWN_LOAD)


def horizon_label(h: Column) -> Column:
    return F.concat(F.lit("t+"), h.cast("string"))


def iso_time(ts: Column) -> Column:
    """Zone-free: the text of a TIMESTAMP_NTZ is its own fields."""
    return F.replace(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def minute_time(ts: Column) -> Column:
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 16)


def residual(actual: Column, forecast: Column) -> Column:
    return actual - forecast


def percentage_error(actual: Column, forecast: Column) -> Column:
    return F.abs((actual - forecast) / safe_denominator(actual)) * 100


def pinball(actual: Column, forecast: Column, q: float) -> Column:
    d = actual - forecast
    return F.greatest(d * q, d * (q - 1))


def covered(actual: Column, lower: Column, upper: Column) -> Column:
    return ((actual >= lower) & (actual <= upper)).cast("double")


def repaired_lower(lower: Column, point: Column) -> Column:
    return F.least(lower, point)


def repaired_upper(upper: Column, point: Column) -> Column:
    return F.greatest(upper, point)
