import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom.operators import gaps, profile, resample
from meterloom.operators.chunks import time_chunks

N = None


def readings(spark, values, meter="a", step=60, start="2024-01-01"):
    """One column ``x`` of readings ``step`` seconds apart."""
    times = pd.Timestamp(start) + pd.to_timedelta(np.arange(len(values)) * step, unit="s")
    rows = [(meter, t.to_pydatetime(), i, v) for i, (t, v) in enumerate(zip(times, values))]
    return spark.createDataFrame(rows, "meter_id string, ts timestamp_ntz, row_id long, x double")


def fill(df, **kw):
    rows = gaps.interpolate_short_gaps(df, ["x"], **kw).orderBy("meter_id", "ts", "row_id").collect()
    return [r.x for r in rows], [r.x_is_short_imputed for r in rows]


def pandas_fill(values, max_gap):
    """The definition, by pandas: interpolate everything, keep only the short gaps."""
    s = pd.Series(values, dtype="float64")
    missing = s.isna()
    size = missing.groupby((~missing).cumsum()).transform("sum")
    short = missing & (size <= max_gap)
    return s.mask(short, s.interpolate()), short.astype(int)


# Chunks of one day, of one minute (one reading), and crowded ones cut down to few rows.
CHUNKINGS = [{}, {"seconds": 60}, {"seconds": 300}, {"max_rows": 2}, {"max_rows": None}]


@pytest.mark.parametrize("chunking", CHUNKINGS)
def test_short_gap_fill(spark, chunking):
    values = [N, N, 1.0, N, N, 4.0, N, N, N, 9.0, N]
    got, flags = fill(readings(spark, values), max_gap=2, **chunking)
    assert got == [N, N, 1.0, 2.0, 3.0, 4.0, N, N, N, 9.0, 9.0]
    assert flags == [1, 1, 0, 1, 1, 0, 0, 0, 0, 0, 1]


@pytest.mark.parametrize("chunking", [{"seconds": 3600}, {"seconds": 60}, {"max_rows": 7}])
@pytest.mark.parametrize("share", [0.3, 0.9])
def test_random_series_equal_pandas(spark, chunking, share):
    rng = np.random.default_rng(7)
    values = np.where(rng.random(400) < share, np.nan, rng.normal(size=400))
    df = readings(spark, [N if np.isnan(v) else float(v) for v in values])
    got, flags = fill(df, max_gap=5, **chunking)
    want, want_flags = pandas_fill(values, 5)
    np.testing.assert_allclose(np.array(got, dtype=float), want, rtol=1e-12)
    assert flags == list(want_flags)


def test_all_missing_meter(spark):
    assert fill(readings(spark, [N, N, N]), max_gap=5) == ([N, N, N], [1, 1, 1])
    assert fill(readings(spark, [N, N, N]), max_gap=2) == ([N, N, N], [0, 0, 0])


def test_meters_do_not_mix(spark):
    both = readings(spark, [1.0, N], "a").unionByName(readings(spark, [N, 5.0], "b"))
    assert fill(both, max_gap=3) == ([1.0, 1.0, N, 5.0], [0, 1, 1, 0])


@pytest.mark.parametrize("chunking", CHUNKINGS)
def test_islands(spark, chunking):
    df = readings(spark, [N, 1.0, N, N, 2.0, 3.0, N])
    rows = gaps.gap_islands(df, "x", **chunking).orderBy("ts").collect()
    assert [r.island for r in rows] == [0, 1, 1, 1, 2, 3, 3]
    assert [r.gap for r in rows] == [1, 2, 2, 2, 0, 1, 1]


def test_equal_times_are_ordered_by_row_id(spark):
    df = readings(spark, [1.0, N, 3.0], step=0)
    assert fill(df, max_gap=2)[0] == [1.0, 2.0, 3.0]


def hot_meter(spark):
    """One meter and week with most rows: half of them spread, half of them at one time."""
    df = readings(spark, [1.0] * 600, "hot", step=1)
    same = readings(spark, [2.0] * 600, "hot", step=0, start="2024-01-01 00:03:20")
    df = df.unionByName(same.withColumn("row_id", F.col("row_id") + 1000))
    for i in range(5):
        df = df.unionByName(readings(spark, [3.0] * 18, f"m{i}"))
    return df


def test_crowded_interval_and_shared_time_are_cut(spark):
    cut = time_chunks(hot_meter(spark), max_rows=100)
    sizes = cut.groupBy("meter_id", "_chunk", "_sub", "_piece").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    assert cut.count() == 1200 + 90


def test_pieces_follow_the_order_of_readings(spark):
    cut = time_chunks(hot_meter(spark), max_rows=50).filter("meter_id = 'hot'")
    rows = cut.orderBy("ts", "row_id").select("_chunk", "_sub", "_piece").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)


def test_crowded_fill_equals_uncut_fill(spark):
    rng = np.random.default_rng(11)
    keep = rng.random(1290) < 0.6
    hot = hot_meter(spark).toPandas().sort_values(["meter_id", "ts", "row_id"])
    hot["x"] = np.where(keep, rng.normal(size=1290), np.nan)
    df = spark.createDataFrame(hot).withColumns(
        {"ts": F.col("ts").cast("timestamp_ntz"), "x": F.nanvl("x", F.lit(None))}
    )
    assert fill(df, max_gap=3, max_rows=50) == fill(df, max_gap=3, max_rows=None)


# -- resampling and profile ------------------------------------------------------
def test_resample_rules(spark):
    df = readings(spark, [N, N], step=600, start="2024-01-01 00:10").unionByName(
        readings(spark, [3.0, N], step=60, start="2024-01-01 02:05")
    )
    total = resample.resample_sum(df, ["x"]).orderBy("hour").collect()
    mean = resample.resample_mean(df, ["x"]).orderBy("hour").collect()
    assert [r.x for r in total] == [0.0, 0.0, 3.0]
    assert [r.x for r in mean] == [N, N, 3.0]
    kept = resample.resample_sum(df, ["x"], empty_sum="null").orderBy("hour").collect()
    assert [r.x for r in kept] == [N, N, 3.0]
    flags = df.withColumn("f", F.col("x").isNull().cast("int"))
    assert [r.f for r in resample.resample_max_flag(flags, ["f"]).orderBy("hour").collect()] == [1, 0, 1]


def test_spine_length_and_borders(spark):
    bounds = spark.sql(
        "select 'a' meter_id, timestamp_ntz'2023-12-30 22:00:00' first_hour, "
        "timestamp_ntz'2024-03-01 01:00:00' last_hour"
    )
    hours = [r.hour for r in resample.hourly_spine(bounds).orderBy("hour").collect()]
    want = pd.date_range("2023-12-30 22:00", "2024-03-01 01:00", freq="h")
    assert hours == list(want.to_pydatetime())


def test_profile_fills_from_training_weeks_only(spark):
    hours = pd.date_range("2024-01-01", periods=24 * 7 * 4, freq="h")
    values = [float(i // (24 * 7)) for i in range(len(hours))]
    values[-1] = N
    rows = [("a", h.to_pydatetime(), v) for h, v in zip(hours, values)]
    df = spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz, x double")
    out = profile.profile_impute(df, ["x"], "2024-01-22 00:00:00").orderBy("hour").collect()
    assert out[-1].x == 1.0 and out[-1].x_is_profile_imputed == 1
    assert sum(r.x_is_profile_imputed for r in out) == 1


def test_profile_medians_are_exact_and_skip_nulls(spark):
    rows = [("a", pd.Timestamp("2024-01-01") + pd.Timedelta(weeks=w), x, y) for w, (x, y) in enumerate([(3.0, N), (0.1, N), (N, N), (0.2, 7.0)])]
    df = spark.createDataFrame([(m, t.to_pydatetime(), x, y) for m, t, x, y in rows], "meter_id string, hour timestamp_ntz, x double, y double")
    got = profile.seasonal_profile(df, ["x", "y"], "2024-02-01 00:00:00").collect()
    want = df.agg(F.median("x").alias("x"), F.median("y").alias("y")).first()
    assert [(r.x_profile, r.y_profile) for r in got] == [(want.x, want.y)]
    two = profile.seasonal_profile(df.limit(2), ["x", "y"], "2024-02-01 00:00:00").first()
    assert two.x_profile == df.limit(2).agg(F.median("x")).first()[0] and two.y_profile is None


def test_slices_fill_gaps_of_the_load_once(spark, tmp_path):
    """The gap fill runs once a query, and of one column, where only the load is used."""
    from pathlib import Path

    from meterloom.plans.queries import QUERIES
    from meterloom.session import shared_dir

    events = [(i, pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i), i % 2, "view", float(i % 50), f'{{"k": {i % 100}}}') for i in range(700)]
    frame = spark.createDataFrame(
        [(i, t.to_pydatetime(), u, e, v, p) for i, t, u, e, v, p in events],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    frame.write.parquet(str(tmp_path / "events.parquet"))
    found = lambda: set(Path(shared_dir(spark)).glob("raw-hourly-*"))
    before = found()
    assert QUERIES["slice_by_load_level"](spark, str(tmp_path)).count() > 0
    (one,) = found() - before
    assert spark.read.parquet(str(one)).columns == ["meter_id", "hour", "load", "load_is_short_imputed"]


def test_spine_unfolds_after_the_join(spark):
    """The hours of the spine are made last: they are neither joined nor sorted."""
    df = readings(spark, [1.0, 2.0, N, 4.0], step=40_000, start="2024-01-30 20:00")
    out = resample.resample_sum(df, ["x"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(_first" in plan.split("Join")[0]
    got = {str(r.hour)[5:13]: r.x for r in out.collect()}
    assert len(got) == 34 and got["01-30 20"] == 1.0 and got["01-31 07"] == 2.0 and got["02-01 05"] == 4.0
    assert set(got.values()) == {0.0, 1.0, 2.0, 4.0}


def test_spine_keeps_null_meters_and_wider_bounds(spark):
    rows = [(None, "2024-01-01 01:30:00", 1.0), (None, "2024-01-01 03:30:00", 1.0), ("a", "2024-03-01 00:10:00", 5.0), ("a", "2024-05-01 00:00:00", 9.0)]
    df = spark.createDataFrame([(m, pd.Timestamp(t).to_pydatetime(), x) for m, t, x in rows], "meter_id string, ts timestamp_ntz, x double")
    empty = [r.x for r in resample.resample_mean(df.filter("meter_id IS NULL"), ["x"]).collect()]
    assert empty == [N, N, N]
    bounds = spark.sql("select 'a' meter_id, timestamp_ntz'2024-01-31 22:00:00' first_hour, timestamp_ntz'2024-03-01 01:00:00' last_hour")
    got = resample.resample_mean(df.filter("meter_id = 'a'"), ["x"], bounds).orderBy("hour").collect()
    want = pd.date_range("2024-01-31 22:00", "2024-03-01 01:00", freq="h")
    assert [r.hour for r in got] == list(want.to_pydatetime())
    assert [r.x for r in got if r.x is not None] == [5.0] and got[-2].x == 5.0


def test_rows_without_nulls_meet_no_profile(spark):
    rows = [("a", (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)).to_pydatetime(), N if i == 190 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz, x double")
    out = profile.profile_impute(df, ["x"], "2024-02-01 00:00:00")
    assert out._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith("Union")
    got = out.orderBy("hour").collect()
    assert [r.x for r in got] == [22.0 if i == 190 else float(i) for i in range(200)]
    assert [i for i, r in enumerate(got) if r.x_is_profile_imputed] == [190]
    none = profile.profile_impute(df.filter("x IS NOT NULL"), ["x"], "2024-02-01 00:00:00", lacking=[])
    assert "Join" not in none._jdf.queryExecution().optimizedPlan().toString()
    assert {r.x_is_profile_imputed for r in none.collect()} == {0}
