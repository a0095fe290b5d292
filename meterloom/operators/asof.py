"""As-of join: each left row with the last right row at or before its time, by key.

Both sides become one table of rows in time order, and the last right row so far is a running window. A key is cut
into time buckets, so that no task sees it whole: what a bucket begins with, the last right row of all earlier
buckets, is a summary row that takes part in the bucket's window as its first row. There is no join by range, no
join at all, and each side is shuffled once, by (key, bucket). The right side is read twice; store it before if
it is costly.

Right rows at one time are told apart by ``tie`` (the largest counts). A left row without a key or a time, or with
no right row before it, has nulls (``how="left"``) or goes (``how="inner"``); right rows without a key or a time
are never found. With ``tolerance_seconds`` an older right row counts as none. ``strict`` leaves out right rows at the left row's
own time. Times may be zone-free. Column names of the two sides may clash: the right side's columns come out under the names given in ``take``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.calendar import epoch_micros


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    take: Mapping[str, str],
    *,
    tie: Sequence[str] = (),
    how: str = "left",
    strict: bool = False,
    tolerance_seconds: float | None = None,
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """The left columns and, under the names that are the values of ``take``, right columns (its keys)."""
    if how not in ("left", "inner"):
        raise ValueError(f"how is 'left' or 'inner', not {how!r}")
    if clash := set(take.values()) & set(left.columns):
        raise ValueError(f"the left side has columns {sorted(clash)} already")
    keys = [f"_k{i}" for i in range(len(by))]

    def keyed(rows: DataFrame, time: str, side: int, payload: Column, match: Column) -> DataFrame:
        at = epoch_micros(F.col(time))
        return rows.select(
            *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)],
            F.floor(at / F.lit(bucket_seconds * 1_000_000)).alias("_bucket"),
            at.alias("_at"),
            # At one time, right rows come first, unless they are not to be found there.
            F.lit(side).alias("_side"),
            payload.alias("_row"),
            match.alias("_match"),
        )

    found = F.struct(
        epoch_micros(F.col(right_time)).alias("_t"), *[F.col(f"`{c}`").alias(f"_tie{i}") for i, c in enumerate(tie)],
        *[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(take)],
    )
    whole = F.struct(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(left.columns)])
    known = F.col(f"`{right_time}`").isNotNull()
    for c in by:
        known &= F.col(f"`{c}`").isNotNull()
    none = F.lit(None)
    rights = right.where(known)
    match_type = rights.select(found.alias("m")).schema["m"].dataType
    row_type = left.select(whole.alias("r")).schema["r"].dataType
    lefts = keyed(left, left_time, 1, whole, none.cast(match_type))
    rights = keyed(rights, right_time, 2 if strict else 0, none.cast(row_type), found)

    # What each bucket that has left rows begins with: the last right row of earlier buckets.
    ends = rights.groupBy(*keys, "_bucket").agg(F.max("_match").alias("_last"))
    asked = lefts.where("_bucket IS NOT NULL").groupBy(*keys, "_bucket").agg(F.lit(True).alias("_asked"))
    chain = ends.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_last", none.cast(match_type)))
    chain = chain.groupBy(*keys, "_bucket").agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("_match", F.last("_last", ignorenulls=True).over(earlier)).where("_asked AND _match IS NOT NULL")
    carried = carried.select(
        *keys, "_bucket", F.lit(None).cast("long").alias("_at"), F.lit(-1).alias("_side"), none.cast(row_type).alias("_row"), "_match"
    )

    rows = lefts.unionByName(rights).unionByName(carried)
    order = [F.asc_nulls_first("_at"), "_side", "_match"]
    upto = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A left row without a time comes before all, and the key of null groups with itself: both find nothing.
    joined = rows.withColumn("_found", F.last("_match", ignorenulls=True).over(upto)).where("_row IS NOT NULL")
    usable = F.col("_at").isNotNull()
    for k in keys:
        usable &= F.col(k).isNotNull()
    if tolerance_seconds is not None:
        usable &= F.col("_at") - F.col("_found._t") <= int(tolerance_seconds * 1_000_000)
    joined = joined.withColumn("_found", F.when(usable, F.col("_found")))
    if how == "inner":
        joined = joined.where("_found IS NOT NULL")
    return joined.select(
        *[F.col(f"_row._c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"_found._v{i}").alias(name) for i, name in enumerate(take.values())],
    )
