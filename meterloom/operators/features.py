"""Feature matrix of the hourly series: clip, lags, rolling statistics, EWMA, lead targets.

Every window runs over (meter, time bucket) with halo rows, so one meter can use many tasks.
On the gap-free spine row offsets are hour offsets. All windows share partitioning and order,
so they need one exchange and one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meterloom.config import (
    CLIP_PERCENTILES,
    DEEPEST_LAG,
    EWMA_SPANS,
    EXOG_LAGS,
    HORIZON,
    LONG_WINDOW,
    SHORT_WINDOW,
    TARGET_LAGS,
    Roles,
    feature_columns,
    profile_flag,
    short_flag,
    target_columns,
)
from meterloom.functions.calendar import add_hours, calendar_block
from meterloom.functions.scalars import clip
from meterloom.operators.chunks import BUCKET, core_rows, ewma_halo, halo_buckets

BUCKET_HOURS = 8_760


def series_window() -> WindowSpec:
    """One bucket of one meter in time order; every window here shares it."""
    return Window.partitionBy("meter_id", BUCKET).orderBy("hour")


# -- clipping ----------------------------------------------------------------
def clip_bounds(hourly: DataFrame, columns: Sequence[str], val_start: str) -> DataFrame:
    """Training p1/p99 per meter as ``<c>_p`` arrays.

    Exact: a meter contributes one value per hour of the training period, which the calendar
    bounds whatever the number of raw readings.
    """
    train = hourly.filter(F.col("hour") < F.lit(val_start).cast("timestamp_ntz"))
    levels = F.array(*[F.lit(p) for p in CLIP_PERCENTILES])
    return train.groupBy("meter_id").agg(
        *[F.percentile(c, levels).alias(f"{c}_p") for c in columns]
    )


def cleaned_name(c: str, roles: Roles) -> str:
    return "load_cleaned" if c == roles.target else f"{c}_cleaned"


def clip_columns(hourly: DataFrame, roles: Roles, bounds: DataFrame | None) -> DataFrame:
    """Add ``*_cleaned``; ``bounds=None`` copies the values. A meter without bounds is not cut."""
    if bounds is None:
        return hourly.withColumns({cleaned_name(c, roles): F.col(c) for c in roles.all_cols})
    joined = hourly.join(bounds, "meter_id", "left")
    cleaned = {
        cleaned_name(c, roles): clip(F.col(c), F.col(f"{c}_p")[0], F.col(f"{c}_p")[1])
        for c in roles.all_cols
    }
    return joined.withColumns(cleaned).drop(*[f"{c}_p" for c in roles.all_cols])


# -- window expressions ------------------------------------------------------
def lag_of(c: str, k: int) -> Column:
    return F.lag(c, k).over(series_window())


def lead_of(c: str, k: int) -> Column:
    return F.lead(c, k).over(series_window())


# -- rolling statistics --------------------------------------------------------
# A frame of 168 rows costs 168 updates a row. Instead, frames of 6 rows are aggregated once,
# 4 of them at lags 0, 6, 12, 18 make 24 rows, and 7 of those make 168. Sums, minima, maxima
# and squared deviations all combine without subtracting, so nothing cancels. A part's sum is null
# unless the part is complete; nulls carry through and void the other statistics.
_LEVELS = (6, 4, 7)


@dataclass(frozen=True)
class Rolling:
    """``fn`` (mean, std, min or max) of ``column`` over ``rows`` rows."""

    name: str
    fn: str
    column: str
    rows: int


def _part(kind: str, c: str, rows: int) -> str:
    return f"_{kind}{rows}_{c}"


def _first_level(columns: dict[str, set[str]], rows: int, through_now: bool) -> dict[str, Column]:
    window = series_window()
    frame = window.rowsBetween(1 - rows, 0) if through_now else window.rowsBetween(-rows, -1)
    primitive = {
        "sum": lambda c: F.when(F.count(c).over(frame) == rows, F.sum(c).over(frame)),
        "dev": lambda c: F.var_pop(c).over(frame) * rows,
        "min": lambda c: F.min(c).over(frame),
        "max": lambda c: F.max(c).over(frame),
    }
    return {
        _part(kind, c, rows): primitive[kind](c)
        for c, kinds in columns.items()
        for kind in sorted(kinds)
    }


def _combine(frames: DataFrame, columns: dict[str, set[str]], rows: int, pieces: int) -> DataFrame:
    window = series_window()

    def parts(kind: str, c: str) -> list[Column]:
        name = _part(kind, c, rows)
        return [F.col(name), *[F.lag(name, j * rows).over(window) for j in range(1, pieces)]]

    # Deviations about the pieces' own means, then of those means about the common one. The
    # common mean is a column of its own so that it is computed once a row.
    combined = {
        _part(kind, c, rows * pieces): {"min": F.least, "max": F.greatest}[kind](*parts(kind, c))
        if kind in ("min", "max")
        else reduce(add, parts(kind, c))
        for c, kinds in columns.items()
        for kind in sorted(kinds)
    }
    frames = frames.withColumns(combined)
    apart = {}
    for c, kinds in columns.items():
        if "dev" in kinds:
            mean = F.col(_part("sum", c, rows * pieces)) / (rows * pieces)
            offsets = [(p / rows - mean) for p in parts("sum", c)]
            name = _part("dev", c, rows * pieces)
            apart[name] = F.col(name) + reduce(add, [o * o for o in offsets]) * rows
    return frames.withColumns(apart) if apart else frames


def with_rolling(
    series: DataFrame, wanted: Sequence[Rolling], through_now: bool = False
) -> DataFrame:
    """Add rolling statistics of the rows before the current one (or through it).

    ``series`` carries halo buckets. Window lengths are those of ``_LEVELS``: 6, 24 or 168.
    """
    needs = {"mean": set(), "std": {"dev"}, "min": {"min"}, "max": {"max"}}
    rows, frames = 1, series
    for level, pieces in enumerate(_LEVELS):
        columns: dict[str, set[str]] = {}
        for w in wanted:
            if w.rows >= rows * pieces:
                columns.setdefault(w.column, {"sum"}).update(needs[w.fn])
        if not columns:
            break
        if level == 0:
            frames = frames.withColumns(_first_level(columns, pieces, through_now))
        else:
            frames = _combine(frames, columns, rows, pieces)
        rows *= pieces

    def result(w: Rolling) -> Column:
        total = F.col(_part("sum", w.column, w.rows))
        if w.fn == "mean":
            return total / w.rows
        if w.fn == "std":
            deviations = F.col(_part("dev", w.column, w.rows))
            return F.when(total.isNotNull(), F.sqrt(deviations / (w.rows - 1)))
        return F.when(total.isNotNull(), F.col(_part(w.fn, w.column, w.rows)))

    return frames.select(*series.columns, *[result(w).alias(w.name) for w in wanted])


# -- EWMA --------------------------------------------------------------------
# y_i = d_i y_(i-1) + g_i x_i is a weighted running sum once each term is divided by the
# product of the d so far. Blocks of B valid rows keep that product representable, and B is
# chosen so that only the previous block's end still carries weight in double precision.
# Nulls age the old mean without replacing it, so d and g depend on the nulls just before.
def with_ewma(series: DataFrame, c: str, spans: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Add, per span, the exponentially weighted mean (unadjusted weights) of the rows *before*.

    ``series`` carries halo buckets; within one, ``ewma_halo(span)`` valid rows must precede the
    core, which a cleaned series always has.
    """
    size = max(ewma_halo(s) for s in spans)
    if len(spans) > 1 and max(-math.log(1 - 2 / (s + 1)) for s in spans) * size > 600:
        for span, name in zip(spans, names, strict=True):
            series = with_ewma(series, c, [span], [name])
        return series

    series_order = series_window()
    before = series_order.rowsBetween(Window.unboundedPreceding, -1)
    through = series_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_block = (
        Window.partitionBy("meter_id", BUCKET, "_block")
        .orderBy("hour")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    valid = F.col(c).isNotNull()
    rows = series.withColumns(
        {"_i": F.row_number().over(series_window()), "_valid": F.count(c).over(through)}
    ).withColumns(
        {
            "_seen": F.max(F.when(valid, F.col("_i"))).over(before),
            "_block": F.floor(F.greatest(F.col("_valid") - 1, F.lit(0)) / size),
        }
    )

    log_decay, gained = {}, {}
    rows = rows.withColumns(
        {
            f"_a{s}": F.greatest(
                F.pow(F.lit(1 - 2.0 / (s + 1)), F.col("_i") - F.col("_seen")), F.lit(1e-200)
            )
            for s in spans
        }
    )
    for s in spans:
        a, aged = 2.0 / (s + 1), F.col(f"_a{s}")
        first = F.col("_seen").isNull()
        log_decay[f"_d{s}"] = F.when(valid & ~first, F.ln(aged / (aged + a))).otherwise(0.0)
        gain = F.when(first, 1.0).otherwise(F.lit(a) / (aged + a))
        gained[f"_g{s}"] = F.when(valid, gain * F.col(c)).otherwise(0.0)
    rows = rows.withColumns({**log_decay, **gained})
    rows = rows.withColumns({f"_d{s}": F.sum(f"_d{s}").over(in_block) for s in spans})
    rows = rows.withColumns(
        {
            f"_y{s}": F.exp(f"_d{s}")
            * F.sum(F.col(f"_g{s}") * F.exp(-F.col(f"_d{s}"))).over(in_block)
            for s in spans
        }
    )
    closes = F.lead("_block").over(series_window()) != F.col("_block")
    rows = rows.withColumns({f"_e{s}": F.when(closes, F.col(f"_y{s}")) for s in spans})
    rows = rows.withColumns(
        {f"_e{s}": F.last(f"_e{s}", ignorenulls=True).over(before) for s in spans}
    )
    rows = rows.withColumns(
        {
            f"_y{s}": F.col(f"_y{s}") + F.exp(f"_d{s}") * F.coalesce(f"_e{s}", F.lit(0.0))
            for s in spans
        }
    )
    shown = {
        name: F.when(F.col("_seen").isNotNull(), F.lag(f"_y{s}", 1).over(series_window()))
        for s, name in zip(spans, names, strict=True)
    }
    return rows.select(*series.columns, *[e.alias(n) for n, e in shown.items()])


# -- the matrix --------------------------------------------------------------
def windowed(
    hourly: DataFrame,
    columns: dict[str, Column],
    before: int,
    after: int = 0,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    """Add window expressions built by this module's helpers to an hourly series."""
    bucketed = halo_buckets(hourly, bucket_hours, before, after)
    return core_rows(bucketed.withColumns(columns))


def ewma(
    hourly: DataFrame,
    column: str,
    spans: Sequence[int] = EWMA_SPANS,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    halo = max(ewma_halo(s) for s in spans)
    bucketed = halo_buckets(hourly, bucket_hours, halo)
    return core_rows(with_ewma(bucketed, column, spans, [f"ewm_mean_{s}" for s in spans]))


def rolling(
    hourly: DataFrame,
    wanted: Sequence[Rolling],
    through_now: bool = False,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    bucketed = halo_buckets(hourly, bucket_hours, max(w.rows for w in wanted))
    return core_rows(with_rolling(bucketed, wanted, through_now))


def lag_columns(roles: Roles) -> dict[str, Column]:
    columns = {f"load_lag_{k}": lag_of("load_cleaned", k) for k in TARGET_LAGS}
    for c in roles.exog:
        columns |= {f"{c}_lag_{k}": lag_of(f"{c}_cleaned", k) for k in EXOG_LAGS}
    return columns


def rolling_features(roles: Roles) -> list[Rolling]:
    load = "load_cleaned"
    return [
        *[
            Rolling(f"rolling_{fn}_{SHORT_WINDOW}", fn, load, SHORT_WINDOW)
            for fn in ("mean", "std", "min", "max")
        ],
        *[Rolling(f"rolling_{fn}_{LONG_WINDOW}", fn, load, LONG_WINDOW) for fn in ("mean", "std")],
        *[
            Rolling(f"{c}_rolling_mean_{SHORT_WINDOW}", "mean", f"{c}_cleaned", SHORT_WINDOW)
            for c in roles.exog
        ],
    ]


def lead_target_columns(target: str, horizon: int = HORIZON) -> dict[str, Column]:
    return {f"target_h{h}": lead_of(target, h) for h in range(1, horizon + 1)}


def feature_frame(
    hourly: DataFrame,
    roles: Roles,
    bounds: DataFrame | None,
    with_targets: bool = True,
    bucket_hours: int = BUCKET_HOURS,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """(meter_id, hour) with all features in DOUBLE and, if wanted, the 24 unclipped targets."""
    before = max(DEEPEST_LAG, *[ewma_halo(s) for s in EWMA_SPANS])
    after = HORIZON if with_targets else 0
    needed = hourly.select(
        "meter_id",
        "hour",
        *roles.all_cols,
        *[f(c) for c in roles.all_cols for f in (short_flag, profile_flag)],
        *passthrough,
    )
    cleaned = clip_columns(needed, roles, bounds)
    bucketed = halo_buckets(cleaned, bucket_hours, before, after)
    # EWMA first: it sorts twice more, and the rows are still narrow.
    weighted = with_ewma(bucketed, "load_cleaned", EWMA_SPANS, [f"ewm_mean_{s}" for s in EWMA_SPANS])
    targets = lead_target_columns(roles.target) if with_targets else {}
    rolled = with_rolling(weighted, rolling_features(roles))
    full = rolled.withColumns({**lag_columns(roles), **targets})
    keep = ["meter_id", "hour", *feature_columns(roles), *targets, *passthrough]
    return core_rows(full, keep)


def complete_cases(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return features.na.drop(how="any", subset=list(columns))


def downcast(features: DataFrame) -> DataFrame:
    """DOUBLE columns to FLOAT; flags and keys keep their type."""
    return features.select(
        *[F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in features.dtypes]
    )


def feature_matrix(
    hourly: DataFrame,
    roles: Roles,
    val_start: str,
    outlier_clipping: bool = True,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    """Features and targets, complete cases only, in single precision."""
    bounds = clip_bounds(hourly, roles.all_cols, val_start) if outlier_clipping else None
    frame = feature_frame(hourly, roles, bounds, bucket_hours=bucket_hours)
    return downcast(complete_cases(frame, feature_columns(roles) + target_columns()))


def select_features(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    return matrix.select("meter_id", "hour", *columns)


# -- one origin --------------------------------------------------------------
#: Hours before an origin that its features can reach.
HISTORY_REACH = max(DEEPEST_LAG, *[ewma_halo(s) for s in EWMA_SPANS])


def origin_features(
    hourly: DataFrame, roles: Roles, origin: str, bounds: DataFrame | None
) -> DataFrame:
    """Feature row of every meter at one origin; needs no hour after it.

    Only the hours a feature can reach are read; the range is pushed to the scan.
    """
    at = F.lit(origin).cast("timestamp_ntz")
    recent = hourly.filter(F.col("hour").between(add_hours(at, -HISTORY_REACH), at))
    frame = feature_frame(recent, roles, bounds, with_targets=False)
    return downcast(complete_cases(frame.filter(F.col("hour") == at), feature_columns(roles)))


def latest_origin(features: DataFrame) -> DataFrame:
    """Newest row per meter as a partial-aggregated maximum instead of a sort."""
    row = F.struct(*features.columns)
    return features.groupBy("meter_id").agg(F.max_by(row, "hour").alias("_r")).select("_r.*")


def append_future_rows(hourly: DataFrame, columns: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Add ``horizon`` zero rows after each meter's last hour."""
    last = hourly.groupBy("meter_id").agg(F.max("hour").alias("last"))
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    future = last.select("meter_id", "last", step.alias("h")).select(
        "meter_id",
        add_hours(F.col("last"), F.col("h")).alias("hour"),
        *[F.lit(0.0).alias(c) for c in columns],
    )
    return hourly.select("meter_id", "hour", *columns).unionByName(future)


def align_on_time(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, ["meter_id", "hour"], "full")


# -- long form ---------------------------------------------------------------
def horizon_long(
    wide: DataFrame, keys: Sequence[str], value: str = "actual", horizon: int = HORIZON
) -> DataFrame:
    """24 target columns to one row per horizon, by unfolding each row in place."""
    values = F.array(*[F.col(c) for c in target_columns(horizon)])
    return wide.select(*keys, F.posexplode(values).alias("_p", value)).select(
        *keys, (F.col("_p") + 1).alias("h"), value
    )


def with_calendar(long: DataFrame, origin: str = "hour") -> DataFrame:
    """Add target_time and its calendar block to (origin, h) rows."""
    timed = long.withColumn("target_time", add_hours(F.col(origin), F.col("h")))
    return timed.select("*", *calendar_block(F.col("target_time")))
