import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom.config import HOUSEHOLD, feature_columns, target_columns
from meterloom.operators import baselines
from meterloom.operators import features as feat
from meterloom.operators.chunks import ewma_halo, halo_buckets


def series(spark, values, meter="a", start="2024-01-01"):
    hours = pd.date_range(start, periods=len(values), freq="h")
    rows = [
        (meter, h.to_pydatetime(), None if np.isnan(v) else float(v)) for h, v in zip(hours, values)
    ]
    return spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz, x double")


def column(df, name):
    pdf = df.orderBy("hour").select(name).toPandas()
    return pdf[name].to_numpy(dtype=float)


RNG = np.random.default_rng(3)
VALUES = RNG.gamma(2.0, 40.0, size=1500)


@pytest.mark.parametrize("bucket", [100, 500, 10**6])
def test_rolling_equals_pandas(spark, bucket):
    wanted = [
        feat.Rolling(f"{fn}_{w}", fn, "x", w) for fn in ("mean", "std", "min", "max") for w in (24, 168)
    ]
    got = feat.rolling(series(spark, VALUES), wanted, bucket_hours=bucket)
    shifted = pd.Series(VALUES).shift(1)
    for w in wanted:
        want = getattr(shifted.rolling(w.rows), w.fn)()
        np.testing.assert_allclose(column(got, w.name), want, rtol=1e-10, err_msg=w.name)


def test_rolling_through_now(spark):
    got = feat.rolling(series(spark, VALUES), [feat.Rolling("m", "mean", "x", 168)], through_now=True)
    np.testing.assert_allclose(column(got, "m"), pd.Series(VALUES).rolling(168).mean(), rtol=1e-10)


def test_rolling_needs_full_windows_and_has_no_residue(spark):
    values = np.full(400, 5.0)
    values[:50] = 1e6
    values[200] = np.nan
    wanted = [feat.Rolling("m", "mean", "x", 24), feat.Rolling("s", "std", "x", 24)]
    got = feat.rolling(series(spark, values), wanted)
    shifted = pd.Series(values).shift(1).rolling(24)
    np.testing.assert_array_equal(np.isnan(column(got, "m")), shifted.mean().isna())
    assert column(got, "s")[100] == 0.0


@pytest.mark.parametrize("bucket", [600, 10**6])
def test_ewma_equals_pandas(spark, bucket):
    got = feat.ewma(series(spark, VALUES), "x", (12, 24), bucket)
    for span in (12, 24):
        want = pd.Series(VALUES).shift(1).ewm(span=span, adjust=False).mean()
        np.testing.assert_allclose(column(got, f"ewm_mean_{span}"), want, rtol=1e-11)


@pytest.mark.parametrize("share", [0.1, 0.7])
def test_ewma_with_nulls_equals_pandas(spark, share):
    values = np.where(RNG.random(1200) < share, np.nan, VALUES[:1200])
    values[300:700] = np.nan
    got = feat.ewma(series(spark, values), "x", (12, 24), 10**6)
    for span in (12, 24):
        want = pd.Series(values).shift(1).ewm(span=span, adjust=False).mean()
        np.testing.assert_allclose(column(got, f"ewm_mean_{span}"), want, rtol=1e-10)


def test_ewma_of_far_apart_spans(spark):
    got = feat.ewma(series(spark, VALUES), "x", (2, 200), 10**6)
    for span in (2, 200):
        want = pd.Series(VALUES).shift(1).ewm(span=span, adjust=False).mean()
        np.testing.assert_allclose(column(got, f"ewm_mean_{span}"), want, rtol=1e-10)


@pytest.mark.parametrize("bucket", [50, 169, 2000])
def test_lags_and_leads_across_buckets(spark, bucket):
    columns = {"lag": feat.lag_of("x", 169), "lead": feat.lead_of("x", 24)}
    got = feat.windowed(series(spark, VALUES), columns, 169, 24, bucket)
    assert got.count() == len(VALUES)
    np.testing.assert_array_equal(column(got, "lag"), pd.Series(VALUES).shift(169))
    np.testing.assert_array_equal(column(got, "lead"), pd.Series(VALUES).shift(-24))


def test_halo_adds_only_its_share(spark):
    bucketed = halo_buckets(series(spark, VALUES), 500, 169, 24)
    assert bucketed.filter("_core").count() == len(VALUES)
    assert bucketed.count() <= len(VALUES) * (1 + 2 * (169 + 24) / 500)


def test_ewma_halo():
    assert (1 - 2 / 25) ** ewma_halo(24) < 1e-17


# -- the household layout ------------------------------------------------------------
@pytest.fixture(scope="module")
def household(spark):
    n = 400
    hours = pd.date_range("2009-06-20", periods=n, freq="h")
    frame = pd.DataFrame({"meter_id": "a", "hour": hours})
    for i, c in enumerate(HOUSEHOLD.all_cols):
        frame[c] = RNG.gamma(2.0, 10.0 + i, size=n)
        frame[f"{c}_is_short_imputed"] = 0
        frame[f"{c}_is_profile_imputed"] = 0
    df = spark.createDataFrame(frame)
    return df.withColumn("hour", F.col("hour").cast("timestamp_ntz")).cache(), frame


def test_matrix_shape(household):
    df, frame = household
    matrix = feat.feature_matrix(df, HOUSEHOLD, "2009-07-01 00:00:00")
    assert len(feature_columns(HOUSEHOLD)) == 61
    assert matrix.columns == ["meter_id", "hour", *feature_columns(HOUSEHOLD), *target_columns()]
    assert matrix.count() == len(frame) - 169 - 24
    types = dict(matrix.dtypes)
    assert types["load_cleaned"] == types["target_h1"] == "float"
    assert types["Voltage_is_short_imputed"] in ("int", "bigint")


def test_clip_uses_training_percentiles_and_leaves_targets(household):
    df, frame = household
    matrix = feat.feature_matrix(df, HOUSEHOLD, "2009-07-01 00:00:00").toPandas()
    load = frame.set_index("hour")["Global_active_power"]
    train = load[load.index < "2009-07-01"]
    low, high = train.quantile(0.01), train.quantile(0.99)
    want = load.clip(low, high)[matrix["hour"]]
    np.testing.assert_allclose(matrix["load_cleaned"], want.astype("float32"), rtol=1e-6)
    want_target = load.shift(-1)[matrix["hour"]].astype("float32")
    np.testing.assert_allclose(matrix["target_h1"], want_target, rtol=1e-6)


def test_origin_features_need_no_future(household):
    df, frame = household
    last = str(frame["hour"].iloc[-1])
    row = feat.origin_features(df, HOUSEHOLD, last, None)
    assert row.count() == 1
    full = feat.feature_frame(df, HOUSEHOLD, None, with_targets=False)
    want = feat.downcast(feat.latest_origin(full))
    assert row.select(*want.columns).collect() == want.collect()


def test_baselines(spark):
    values = VALUES[:260]
    rows = baselines.baselines_long(series(spark, values), "x", bucket_hours=90).toPandas()
    origins = sorted(rows["origin"].unique())
    assert len(origins) == 260 - 167 - 24
    t, hours = 200, pd.date_range("2024-01-01", periods=260, freq="h")
    at = rows[rows["origin"] == hours[t]].sort_values("h")
    np.testing.assert_allclose(at["actual"], values[t + 1 : t + 25])
    np.testing.assert_allclose(at["daily_naive"], values[t - 23 : t + 1])
    np.testing.assert_allclose(at["weekly_naive"], values[t - 167 : t - 143])
    np.testing.assert_allclose(at["rolling_avg_7d"], values[t - 167 : t + 1].mean(), rtol=1e-12)
    assert (at["target_time"].to_numpy() == hours[t + 1 : t + 25].to_numpy()).all()


def test_future_rows(spark):
    out = feat.append_future_rows(series(spark, VALUES[:5]), ["x"]).orderBy("hour").collect()
    assert len(out) == 29 and out[-1].x == 0.0
    assert out[-1].hour == pd.Timestamp("2024-01-02 04:00").to_pydatetime()
