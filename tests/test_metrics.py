import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.functions import calendar as cal
from meterloom.functions import scalars
from meterloom.operators import metrics, model, reports


def long_rows(spark, actual, point, lower=None, upper=None, h=None):
    n = len(actual)
    rows = [
        (float(a), float(p), float((lower or point)[i]), float((upper or point)[i]), (h or [1] * n)[i])
        for i, (a, p) in enumerate(zip(actual, point))
    ]
    return spark.createDataFrame(rows, "actual double, point double, lower double, upper double, h int")


def one(df):
    return df.first().asDict()


def test_point_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y, f = rng.gamma(2, 3, 200), rng.gamma(2, 3, 200)
    got = one(metrics.point_metrics(long_rows(spark, y, f)))
    assert got["MAE"] == pytest.approx(np.abs(y - f).mean())
    assert got["RMSE"] == pytest.approx(np.sqrt(((y - f) ** 2).mean()))
    assert got["MAPE"] == pytest.approx(np.abs((y - f) / y).mean() * 100)
    assert got["R2"] == pytest.approx(1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_mean_forecast_has_r2_zero(spark):
    assert one(metrics.point_metrics(long_rows(spark, [1, 2, 6], [3, 3, 3])))["R2"] == pytest.approx(0)


def test_zero_actual_is_guarded(spark):
    got = one(metrics.point_metrics(long_rows(spark, [0.0], [1.0])))
    assert got["MAPE"] == pytest.approx(1e5 * 100)


@pytest.mark.parametrize(("forecast", "loss"), [(12.0, 0.1), (8.0, 1.9)])
def test_pinball(spark, forecast, loss):
    df = long_rows(spark, [10.0], [forecast])
    assert df.select(scalars.pinball(F.col("actual"), F.col("point"), 0.95)).first()[0] == pytest.approx(loss)


def test_coverage_includes_bounds(spark):
    df = long_rows(spark, [1.0, 2.0, 3.0, 4.0], [2.0] * 4, [1.0] * 4, [3.0] * 4)
    assert one(metrics.interval_metrics(df))["coverage_rate_90pct"] == 75.0


def test_interval_repair(spark):
    df = long_rows(spark, [0.0], [3.0], [5.0], [2.0])
    low = scalars.repaired_lower(F.col("lower"), F.col("point"))
    high = scalars.repaired_upper(F.col("upper"), F.col("point"))
    assert tuple(df.select(low, high).first()) == (3.0, 3.0)


def test_slices_average_to_the_whole(spark):
    rows = spark.range(5000).select(
        F.lit("a").alias("meter_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))").alias("target_time"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("actual"),
        F.lit(40.0).alias("point"),
    )
    medians = spark.createDataFrame([("a", 50.0)], "meter_id string, train_median double")
    sliced = metrics.with_slices(rows, medians).cache()
    report = metrics.robustness_report(sliced).toPandas()
    assert report.groupby("dimension").size().to_dict() == {
        "hour_of_day": 24,
        "day_type": 2,
        "season": 3,
        "load_level": 2,
    }
    for dimension in ("hour_of_day", "day_type", "season", "load_level"):
        single = metrics.slice_by(sliced, dimension).toPandas().set_index(dimension)
        for _, row in report[report["dimension"] == dimension].iterrows():
            key = int(row["bucket"]) if dimension == "hour_of_day" else row["bucket"]
            for m in ("MAE", "RMSE", "MAPE"):
                assert row[m] == pytest.approx(single.loc[key, m])


def test_load_level_at_the_median_is_low(spark):
    df = spark.createDataFrame([(5.0,), (5.1,)], "y double")
    got = [r[0] for r in df.select(scalars.load_level(F.col("y"), F.lit(5.0))).collect()]
    assert got == [scalars.LOW_LOAD, scalars.HIGH_LOAD]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(5).normal(size=3000)
    df = spark.createDataFrame([(float(v),) for v in values], "residual double")
    got = reports.residual_histogram(df).orderBy("bin").toPandas()
    density, edges = np.histogram(values, bins=60, density=True)
    assert got["count"].sum() == len(values)
    np.testing.assert_allclose(got["density"], density, rtol=1e-9)
    np.testing.assert_allclose(got["left_edge"], edges[:-1], rtol=1e-9)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "residual double")
    assert reports.residual_histogram(df).agg(F.sum("count")).first()[0] == 3


def test_importance_mean_skips_what_a_table_lacks(spark):
    left = spark.createDataFrame([("a", 2.0), ("b", 4.0)], "feature string, importance double")
    right = spark.createDataFrame([("b", 2.0), ("c", 1.0)], "feature string, importance double")
    want = {"a": 2.0, "b": 3.0, "c": 1.0}
    by_join = reports.join_outer_importance(left, right).collect()
    by_union = reports.mean_importance([left, right]).collect()
    assert {r.feature: r.mean_importance for r in by_join} == want
    assert {r.feature: r.mean_importance for r in by_union} == want


# -- calendar ---------------------------------------------------------------------
@pytest.mark.parametrize(
    ("year", "day"),
    [(1995, "04-16"), (2000, "04-23"), (2007, "04-08"), (2010, "04-04"), (2024, "03-31"), (2025, "04-20")],
)
def test_easter(spark, year, day):
    row = spark.range(1).select(cal.easter_sunday(F.lit(year)).cast("string")).first()
    assert row[0] == f"{year}-{day}"


def test_holidays_of_a_year(spark):
    days = {str(r.holiday)[5:] for r in cal.holiday_table(spark, 2024, 2024).collect()}
    assert days == {
        "01-01", "04-01", "05-01", "05-08", "05-09", "05-20", "07-14", "08-15", "11-01", "11-11", "12-25",
    }
    flagged = spark.sql("select explode(sequence(date'2024-01-01', date'2024-12-31')) d")
    hits = flagged.filter(cal.is_holiday(F.col("d")) == 1).collect()
    assert {str(r.d)[5:] for r in hits} == days


def test_calendar_block(spark):
    row = spark.sql("select timestamp_ntz'2024-12-31 23:00:00' t").select(
        *cal.calendar_block(F.col("t"))
    )
    assert row.columns == cal.CALENDAR_COLUMNS and len(row.columns) == 13
    got = one(row)
    assert (got["dayofweek_cat"], got["is_weekend"], got["month_cat"]) == (1, 0, 12)
    assert got["dayofyear_sin"] == pytest.approx(math.sin(2 * math.pi * 366 / 365.25), abs=1e-6)


# -- folds and stopping -----------------------------------------------------------------
def test_folds(spark):
    df = spark.range(103).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))").alias("hour")
    )
    rows = model.ts_cv_folds(df.unionByName(df)).orderBy("rank").collect()
    starts = [min(r.rank for r in rows if r.fold == f) for f in (1, 2, 3)]
    assert starts == [28, 53, 78] and len(rows) == 103


def test_patience():
    assert model.best_iteration([3.0, 2.0, 2.5, 1.0, 1.1, 1.2], 2) == (4, True)
    assert model.best_iteration([3.0, 2.0, 2.5], 2) == (2, False)
    assert model.best_iteration([1.0, 2.0, 2.0, 0.5], 2) == (1, True)


def test_sample_origin_is_repeatable(spark):
    df = spark.range(500).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))").alias("hour")
    )
    draws = {reports.sample_origin(df, "2024-01-10 00:00:00", s).first().hour for s in "aabc"}
    assert len(draws) in (2, 3)
    assert max(draws) <= df.agg(F.max("hour")).first()[0].replace(day=19)
