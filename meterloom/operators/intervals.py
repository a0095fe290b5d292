"""Interval join: pairs of intervals [start, end) that overlap, by key, as an equi-join on time bins.

Bins come in levels, each ``factor`` times as wide as the one below. An interval lives on the lowest level where it
covers ``factor + 1`` bins at most, so a very long one has few bins too, and is known as a guest in its bins of every
level above. Two intervals meet on the higher of their two levels: owner with owner, or owner with guest, never guest
with guest: the join key says which side owns, so that guests, who share few wide bins, never face each other. Of the bins that a pair shares there it is reported in the first. So the rows that are joined grow with
the intervals, and the pairs that are compared with those that overlap or nearly do; there is no join by range.

Points are intervals of one microsecond: ``with_points``. Null or empty intervals (end at or before start) and null keys
overlap nothing. Times may be zone-free. A key whose intervals all overlap gives all its pairs, as the result must.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.calendar import epoch_micros

#: The widest bins are ``factor`` ** 9 times the narrowest: 15,000 years of hours.
LEVELS = 10


def with_points(rows: DataFrame, time: str, end: str = "end") -> DataFrame:
    """Rows with ``end`` just after ``time``: points, for the join below."""
    return rows.withColumn(end, F.col(time) + F.expr("INTERVAL '0.000001' SECOND"))


def _binned(rows: DataFrame, by: Sequence[str], start: str, end: str, side: str, seconds: float, factor: int) -> DataFrame:
    """One row for each bin of the interval: its own level's, and as a guest of every level above."""
    lo, hi = epoch_micros(F.col(f"`{start}`")), epoch_micros(F.col(f"`{end}`")) - 1  # the last microsecond inside
    known = lo <= hi
    for c in by:
        known &= F.col(f"`{c}`").isNotNull()
    widths = [int(seconds * 1_000_000) * factor**k for k in range(LEVELS)]
    # The lowest level where the length is no more than ``factor`` bins; the top level takes the rest.
    own = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        own = F.when(hi - lo < widths[k] * factor, F.lit(k)).otherwise(own)
    placed = rows.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by)],
        F.struct(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rows.columns)]).alias(f"_{side}"),
        lo.alias(f"_lo_{side}"), hi.alias(f"_hi_{side}"), own.alias("_own"),
    ).where(known if isinstance(known, Column) else F.lit(known))
    placed = placed.withColumn("_level", F.explode(F.sequence(F.col("_own"), F.lit(LEVELS - 1))))
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("_level") + 1)
    first, last = F.floor(F.col(f"_lo_{side}") / width), F.floor(F.col(f"_hi_{side}") / width)
    placed = placed.withColumn("_bin", F.explode(F.sequence(first, last)))
    # Whether the left one owns the level: its owners meet all on the right, its guests the owners on the right.
    owns = F.col("_own") == F.col("_level")
    left_owns = F.array(owns) if side == "a" else F.when(owns, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    return placed.select(
        *[f"_k{i}" for i in range(len(by))], "_level", "_bin", F.explode(left_owns).alias("_left_owns"),
        first.alias(f"_first_{side}"), f"_lo_{side}", f"_hi_{side}", f"_{side}",
    )


def _keys(by: Sequence[str]) -> list[str]:
    return [*[f"_k{i}" for i in range(len(by))], "_level", "_bin", "_left_owns"]


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    *,
    bin_seconds: float = 3600,
    factor: int = 8,
    suffix: str = "_right",
) -> DataFrame:
    """All columns of both sides for each pair that overlaps; right columns that clash take ``suffix``."""
    a = _binned(left, by, *left_span, "a", bin_seconds, factor)
    b = _binned(right, by, *right_span, "b", bin_seconds, factor)
    meets = F.lit(True)
    for k in _keys(by):
        meets &= a[k] == b[k]
    overlap = (F.col("_lo_a") <= F.col("_hi_b")) & (F.col("_lo_b") <= F.col("_hi_a"))
    once = a["_bin"] == F.greatest("_first_a", "_first_b")
    pairs = a.join(b, meets & overlap & once)
    names = [c + suffix if c in left.columns else c for c in right.columns]
    if len({*left.columns, *names}) != len(left.columns) + len(names):
        raise ValueError(f"columns clash even with the suffix {suffix!r}")
    return pairs.select(
        *[F.col(f"_a._c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"_b._c{i}").alias(c) for i, c in enumerate(names)],
    )
