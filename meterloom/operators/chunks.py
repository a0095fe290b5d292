"""Cutting a meter's time line so that no task has to hold one meter whole.

Two cuts, both pure functions of the row, so a lost executor can redo its part:

* ``time_chunks``: contiguous pieces of the *readings*. Crowded pieces are cut further;
  operators pass what crosses a border on through a small per-piece summary.
* ``halo_buckets``: overlapping pieces of the *hourly* series. Each bucket gets copies of
  the hours just before and after it, so row-offset windows inside it are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.calendar import epoch_hour, epoch_micros

CHUNK = ("_chunk", "_sub", "_piece")
BUCKET = "_bucket"
_CUTS = 256


def time_chunks(readings: DataFrame, seconds: int = 86_400, max_rows: int | None = None) -> DataFrame:
    """Add ``_chunk``, ``_sub``, ``_piece``: consecutive pieces of a meter in (ts, row_id) order.

    ``_chunk`` is the time interval: a pure function of the row, the same at every size, without a
    look at the data. Readings without a meter or a time have no place in a series and are left
    out; ``unplaced`` counts them.

    ``max_rows`` cuts crowded intervals further, at time quantiles (``_sub``), where a time that
    many rows share becomes a piece of its own, and what is still too large once more (``_piece``),
    by row_id if it is one such time. The cuts are part of the plan; null row_ids come first, and
    row_ids may be numbers or text. Two rounds make ``_CUTS`` ** 2 pieces of an interval at most.
    """
    micros = epoch_micros(F.col("ts"))
    # The filter is stated so that every branch built on the chunks plans one same exchange.
    chunked = readings.withColumn(
        "_chunk", F.floor(micros / F.lit(seconds * 1_000_000))
    ).filter(F.col("meter_id").isNotNull() & F.col("_chunk").isNotNull())
    whole = F.lit(0).cast("long")
    if max_rows is None:
        return chunked.withColumns({"_sub": whole, "_piece": whole})
    interval = ["meter_id", "_chunk"]
    crowded = chunked.groupBy(*interval).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows)
    by_time = _cut_at_quantiles(chunked, interval, crowded, micros, max_rows, "_sub")
    piece = [*interval, "_sub"]
    still = (
        by_time.join(crowded.select(*interval), interval)
        .groupBy(*piece)
        .agg(F.count("*").alias("_n"), (F.min(micros) == F.max(micros)).alias("_one_time"))
        .filter(F.col("_n") > max_rows)
    )
    value = F.when(F.col("_one_time"), _row_order(readings)).otherwise(micros)
    return _cut_at_quantiles(by_time, piece, still, value, max_rows, "_piece")


def unplaced(readings: DataFrame) -> DataFrame:
    """How many readings have no meter or no time, in one row."""
    none = lambda c: F.count_if(F.col(c).isNull())
    return readings.agg(none("meter_id").alias("without_meter"), none("ts").alias("without_time"))


def _row_order(readings: DataFrame) -> Column:
    """A number that rises with row_id: itself, or the first seven bytes of a text."""
    if dict(readings.dtypes)["row_id"] == "string":
        head = F.rpad(F.hex(F.substring(F.encode("row_id", "utf-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    return F.col("row_id").cast("long")


def _cut_at_quantiles(
    rows: DataFrame, keys: list[str], crowded: DataFrame, value: Column, max_rows: int, out: str
) -> DataFrame:
    """Number the stretches of ``value`` between quantiles, within the ``crowded`` groups.

    A value that is itself a quantile gets a stretch of its own, and nulls the first one. Quantiles
    come from a mergeable sketch. Spark sizes the joins.
    """
    columns = rows.columns
    marked = rows.join(crowded, keys)
    extra = [c for c in crowded.columns if c not in keys]
    levels = [i / _CUTS for i in range(1, _CUTS)]
    stride = F.greatest(F.floor(F.lit(_CUTS * max_rows) / F.col("_n")), F.lit(1))
    cuts = (
        marked.groupBy(*keys, *extra)
        .agg(F.percentile_approx(value, levels, 10_000).alias("_q"))
        .select(
            *keys,
            *extra,
            F.array_distinct(F.filter("_q", lambda _, i: i % stride == 0)).alias("_at"),
        )
    )
    placed = rows.join(cuts, keys, "left")
    number = F.size(F.filter("_at", lambda q: q < value)) * 2 + F.array_contains("_at", value).cast("int")
    numbered = F.when(F.col("_at").isNull(), 0).otherwise(F.coalesce(number, F.lit(-1))).cast("long")
    return placed.select(*columns, numbered.alias(out))


def halo_buckets(
    hourly: DataFrame, bucket_hours: int, before: int, after: int = 0
) -> DataFrame:
    """Copy each hour into every bucket that needs it; ``_core`` marks its own bucket.

    ``before``/``after`` are how many rows a window reaches back and forward. The copies add
    (before + after) / bucket_hours to the rows. Works for any bucket length.
    """
    hour_no = epoch_hour(F.col("hour"))

    def bucket_of(n: Column) -> Column:
        return F.floor(n / F.lit(bucket_hours)).cast("long")

    own = bucket_of(hour_no)
    needed_by = F.sequence(bucket_of(hour_no - after), bucket_of(hour_no + before))
    return hourly.select("*", own.alias("_own"), F.explode(needed_by).alias(BUCKET)).select(
        *hourly.columns, BUCKET, (F.col("_own") == F.col(BUCKET)).alias("_core")
    )


def core_rows(bucketed: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    columns = keep or [c for c in bucketed.columns if c not in (BUCKET, "_core")]
    return bucketed.filter("_core").select(*columns)


def ewma_halo(span: int) -> int:
    """Hours until an exponential weight falls below double precision."""
    return math.ceil(math.log(1e-18) / math.log(1 - 2 / (span + 1)))
