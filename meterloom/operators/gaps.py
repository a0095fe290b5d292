"""Gaps in the readings: islands, short-gap interpolation and its flags.

Positions are row positions in (ts, row_id) order. Each column needs, per row, the nearest
valid reading on either side. Inside a chunk two running windows find it (ascending and
descending; both linear). Across chunks one summary row per chunk is carried along the meter
and joined back, so no task sees more than a chunk of readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import MAX_GAP, short_flag
from meterloom.operators.chunks import CHUNK, time_chunks

ORDER = ("ts", "row_id")
_SEAM = ["meter_id", *CHUNK]


def _anchored(readings: DataFrame, columns: Sequence[str], **chunking) -> DataFrame:
    """Per column c: position and value of the nearest other valid readings.

    ``_p``/``_pv`` lie before the row, ``_n``/``_nv`` after it; ``_c`` counts the valid readings
    up to and including it. Adds ``_pos`` (1-based) and ``_total`` (rows of the meter).
    """
    chunked = time_chunks(readings, **chunking)
    chunk = Window.partitionBy(*_SEAM)
    # Values break ties, so that rows which still tie are alike and both branches number the same.
    forward = chunk.orderBy(*ORDER, *columns)
    upto = forward.rowsBetween(Window.unboundedPreceding, -1)
    through = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = chunk.orderBy(F.desc("_rn"))
    onward = backward.rowsBetween(Window.unboundedPreceding, -1)

    numbered = chunked.withColumn("_rn", F.row_number().over(forward).cast("long"))

    def valid_pos(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col("_rn"))

    # One row per chunk: what its neighbours need to know.
    ends = [F.count("*").alias("_rows")]
    for c in columns:
        ends += [
            F.count(c).alias(f"_count_{c}"),
            F.min(valid_pos(c)).alias(f"_first_{c}"),
            F.max(valid_pos(c)).alias(f"_last_{c}"),
            F.min_by(F.col(c), valid_pos(c)).alias(f"_fv_{c}"),
            F.max_by(F.col(c), valid_pos(c)).alias(f"_lv_{c}"),
        ]
    chain = Window.partitionBy("meter_id").orderBy(*CHUNK)
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy("meter_id")
        .orderBy(*[F.desc(c) for c in CHUNK])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    total = F.sum("_rows").over(Window.partitionBy("meter_id"))
    placed = numbered.groupBy(*_SEAM).agg(*ends).select(
        "*", offset.alias("_offset"), total.alias("_total")
    )

    def last_seen(c: Column, over) -> Column:
        return F.last(c, ignorenulls=True).over(over)

    carried = placed.select(
        *_SEAM,
        "_offset",
        "_total",
        *[
            e
            for c in columns
            for e in (
                F.coalesce(F.sum(f"_count_{c}").over(earlier), F.lit(0)).alias(f"_cc_{c}"),
                last_seen(F.col("_offset") + F.col(f"_last_{c}"), earlier).alias(f"_cp_{c}"),
                last_seen(F.col(f"_lv_{c}"), earlier).alias(f"_cpv_{c}"),
                last_seen(F.col("_offset") + F.col(f"_first_{c}"), later).alias(f"_cn_{c}"),
                last_seen(F.col(f"_fv_{c}"), later).alias(f"_cnv_{c}"),
            )
        ],
    )

    local = numbered.select(
        "*",
        *[
            e
            for c in columns
            for e in (
                last_seen(valid_pos(c), upto).alias(f"_lp_{c}"),
                last_seen(F.col(c), upto).alias(f"_lpv_{c}"),
                F.count(c).over(through).alias(f"_lc_{c}"),
            )
        ],
    ).select(
        "*",
        *[
            e
            for c in columns
            for e in (
                last_seen(valid_pos(c), onward).alias(f"_ln_{c}"),
                last_seen(F.col(c), onward).alias(f"_lnv_{c}"),
            )
        ],
    )
    joined = local.join(carried, _SEAM)
    off = F.col("_offset")
    return joined.select(
        *readings.columns,
        (off + F.col("_rn")).alias("_pos"),
        "_total",
        *[
            e
            for c in columns
            for e in (
                (F.col(f"_cc_{c}") + F.col(f"_lc_{c}")).alias(f"_c_{c}"),
                F.coalesce(off + F.col(f"_lp_{c}"), F.col(f"_cp_{c}")).alias(f"_p_{c}"),
                F.coalesce(F.col(f"_lpv_{c}"), F.col(f"_cpv_{c}")).alias(f"_pv_{c}"),
                F.coalesce(off + F.col(f"_ln_{c}"), F.col(f"_cn_{c}")).alias(f"_n_{c}"),
                F.coalesce(F.col(f"_lnv_{c}"), F.col(f"_cnv_{c}")).alias(f"_nv_{c}"),
            )
        ],
    )


def _gap_length(c: str) -> Column:
    """Nulls between the anchors; a meter's ends count as anchors."""
    before = F.coalesce(F.col(f"_p_{c}"), F.lit(0))
    after = F.coalesce(F.col(f"_n_{c}"), F.col("_total") + 1)
    return after - before - 1


def _is_short(c: str, max_gap: int) -> Column:
    return F.col(c).isNull() & (_gap_length(c) <= max_gap)


def gap_islands(readings: DataFrame, column: str, **chunking) -> DataFrame:
    """``island`` = valid readings up to and including the row; ``gap`` = nulls of that island."""
    found = gap_islands_of(readings, [column], **chunking)
    return found.withColumnsRenamed({f"island_{column}": "island", f"gap_{column}": "gap"})


def gap_islands_of(readings: DataFrame, columns: Sequence[str], **chunking) -> DataFrame:
    """``island_<c>`` and ``gap_<c>`` of several columns from the same two windows."""
    rows = _anchored(readings, columns, **chunking)

    def gap(c: str) -> Column:
        start = F.when(F.col(c).isNotNull(), F.col("_pos")).otherwise(F.coalesce(F.col(f"_p_{c}"), F.lit(0)))
        return F.coalesce(F.col(f"_n_{c}"), F.col("_total") + 1) - start - 1

    found = [e for c in columns for e in (F.col(f"_c_{c}").alias(f"island_{c}"), gap(c).alias(f"gap_{c}"))]
    return rows.select(*readings.columns, *found)


def interpolate_short_gaps(
    readings: DataFrame, columns: Sequence[str], max_gap: int = MAX_GAP, **chunking
) -> DataFrame:
    """Fill gaps of at most ``max_gap`` rows linearly by position and add 0/1 flag columns.

    A short leading gap has nothing to start from: it stays null but is flagged. A short
    trailing gap repeats the last value. Longer gaps stay null.
    """
    rows = _anchored(readings, columns, **chunking)

    def filled(c: str) -> Column:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        pv, nv = F.col(f"_pv_{c}").cast("double"), F.col(f"_nv_{c}").cast("double")
        line = pv + (nv - pv) * (F.col("_pos") - p) / (n - p)
        return F.when(_is_short(c, max_gap), F.coalesce(line, pv)).otherwise(F.col(c))

    kept = [c for c in readings.columns if c not in columns]
    return rows.select(
        *kept,
        *[filled(c).alias(c) for c in columns],
        *[_is_short(c, max_gap).cast("int").alias(short_flag(c)) for c in columns],
    )


def short_gap_flags(
    readings: DataFrame, columns: Sequence[str], max_gap: int = MAX_GAP, **chunking
) -> DataFrame:
    rows = _anchored(readings, columns, **chunking)
    return rows.select(
        *readings.columns,
        *[_is_short(c, max_gap).cast("int").alias(short_flag(c)) for c in columns],
    )


def in_time_order(readings: DataFrame, **chunking) -> DataFrame:
    """Number a meter's readings in (ts, row_id) order, chunk by chunk."""
    rows = _anchored(readings, [], **chunking)
    return rows.select(*readings.columns, F.col("_pos").alias("position"))
