"""Accuracy, calibration and error slices over long forecast rows.

All are plain aggregates: combined before the shuffle, so a hot slice costs no more than a
cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.config import QUANTILES
from meterloom.functions.calendar import day_type, season
from meterloom.functions.scalars import covered, load_level, percentage_error, pinball

POINT_METRICS = ("MAE", "RMSE", "MAPE", "R2")


def mae(actual: Column, forecast: Column) -> Column:
    return F.avg(F.abs(actual - forecast))


def rmse(actual: Column, forecast: Column) -> Column:
    return F.sqrt(F.avg((actual - forecast) * (actual - forecast)))


def mape(actual: Column, forecast: Column) -> Column:
    return F.avg(percentage_error(actual, forecast))


def mape_nonzero(actual: Column, forecast: Column) -> Column:
    """MAPE over non-zero actuals, which the zero guard does not inflate."""
    return F.avg(F.when(actual != 0, percentage_error(actual, forecast)))


def r2(actual: Column, forecast: Column) -> Column:
    sse = F.sum((actual - forecast) * (actual - forecast))
    return 1 - F.try_divide(sse, F.var_pop(actual) * F.count(actual))


_POINT = {"MAE": mae, "RMSE": rmse, "MAPE": mape, "R2": r2}


def point_metrics(
    long: DataFrame, forecast: str = "point", by: Sequence[str] = (), actual: str = "actual"
) -> DataFrame:
    y, f = F.col(actual), F.col(forecast)
    return long.groupBy(*by).agg(*[fn(y, f).alias(name) for name, fn in _POINT.items()])


def interval_metrics(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    y, low, high = F.col("actual"), F.col("lower"), F.col("upper")
    q_low, q_high = QUANTILES
    return long.groupBy(*by).agg(
        F.avg(pinball(y, low, q_low)).alias(f"pinball_{q_low:.2f}"),
        F.avg(pinball(y, high, q_high)).alias(f"pinball_{q_high:.2f}"),
        (F.avg(covered(y, low, high)) * 100).alias("coverage_rate_90pct"),
    )


def method_comparison(long: DataFrame, methods: Sequence[str]) -> DataFrame:
    """All metrics of all methods in one pass, one row per method."""
    y = F.col("actual")
    wide = long.agg(
        *[
            F.struct(*[fn(y, F.col(m)).alias(name) for name, fn in _POINT.items()]).alias(m)
            for m in methods
        ]
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(F.lit(m).alias("method"), *[F.col(m)[n].alias(n) for n in POINT_METRICS])
                for m in methods
            ]
        )
    )
    return wide.select(rows)


def improvement_vs_baseline(
    comparison: DataFrame, baseline: str = "daily_naive"
) -> DataFrame:
    """Percent gain in MAE and RMSE and the R2 difference, one row per method.

    ``comparison`` has one row per method, so a window over all of it stays tiny.
    """
    everything = Window.partitionBy(F.lit(0))

    def base(metric: str) -> Column:
        return F.max(F.when(F.col("method") == baseline, F.col(metric))).over(everything)

    return comparison.select(
        "method",
        *[
            ((base(m) - F.col(m)) / base(m) * 100).alias(f"{m}_gain_pct") for m in ("MAE", "RMSE")
        ],
        (F.col("R2") - base("R2")).alias("R2_difference"),
    )


# -- slices ------------------------------------------------------------------
def train_median(hourly: DataFrame, target: str, val_start: str) -> DataFrame:
    """Median training load per meter (one value per hour of the training period)."""
    train = hourly.filter(F.col("hour") < F.lit(val_start).cast("timestamp_ntz"))
    return train.groupBy("meter_id").agg(F.median(target).alias("train_median"))


def with_slices(long: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Add hour_of_day, day_type, season of the target time and, given medians, load_level.

    The median table has one row a meter; Spark sizes the join. Rows that carry ``train_median``
    already need no table, so it can be joined to hours, before they unfold into forecasts.
    """
    at = F.col("target_time")
    sliced = long.withColumns(
        {"hour_of_day": F.hour(at), "day_type": day_type(at), "season": season(at)}
    )
    if medians is not None:
        # A meter without training rows stays: its load level is unknown.
        sliced = sliced.join(medians, "meter_id", "left")
    if "train_median" not in sliced.columns:
        return sliced
    return sliced.withColumn("load_level", load_level(F.col("actual"), F.col("train_median")))


def _slice_metrics(y: Column, f: Column) -> list[Column]:
    return [mae(y, f).alias("MAE"), rmse(y, f).alias("RMSE"), mape(y, f).alias("MAPE")]


def slice_by(sliced: DataFrame, dimension: str, forecast: str = "point") -> DataFrame:
    aggregates = _slice_metrics(F.col("actual"), F.col(forecast))
    return sliced.groupBy(dimension).agg(*aggregates)


def robustness_report(sliced: DataFrame, forecast: str = "point") -> DataFrame:
    """Every slice dimension as one (dimension, bucket) table from one aggregate.

    Rows are first combined per cell (24 x 2 x 4 x 2 cells at most), then the cells are folded
    into each dimension, so the expansion to four grouping sets touches cells, not forecasts.
    """
    y, f = F.col("actual"), F.col(forecast)
    dims = ["hour_of_day", "day_type", "season", "load_level"]
    cells = sliced.groupBy(*dims).agg(
        F.count("*").alias("_n"),
        F.sum(F.abs(y - f)).alias("_ae"),
        F.sum((y - f) * (y - f)).alias("_se"),
        F.sum(percentage_error(y, f)).alias("_pe"),
    )
    n = F.sum("_n")
    folded = cells.groupingSets([[F.col(d)] for d in dims], *dims).agg(
        F.grouping_id().alias("_gid"),
        (F.sum("_ae") / n).alias("MAE"),
        F.sqrt(F.sum("_se") / n).alias("RMSE"),
        (F.sum("_pe") / n).alias("MAPE"),
    )
    bit = {d: 0b1111 ^ (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)}
    name, bucket = F, F
    for d in dims:
        name = name.when(F.col("_gid") == bit[d], d)
        bucket = bucket.when(F.col("_gid") == bit[d], F.col(d).cast("string"))
    return folded.select(
        name.alias("dimension"), bucket.alias("bucket"), "MAE", "RMSE", "MAPE"
    )


def origin_window_kpi(long: DataFrame, forecast: str = "point") -> DataFrame:
    """MAE and RMSE of each single forecast whose 24 actuals all exist."""
    y, f = F.col("actual"), F.col(forecast)
    return (
        long.groupBy("meter_id", "origin")
        .agg(F.count(y).alias("_n"), mae(y, f).alias("MAE"), rmse(y, f).alias("RMSE"))
        .filter(F.col("_n") == 24)
        .drop("_n")
    )
