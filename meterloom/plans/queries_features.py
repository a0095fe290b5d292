"""Queries over the hourly windows: clip, lags, rolling statistics, EWMA, targets, matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.config import (
    EWMA_SPANS,
    EXOG_LAGS,
    TARGET_LAGS,
    feature_columns,
    target_columns,
)
from meterloom.functions.calendar import truncate_hour
from meterloom.operators import features as feat
from meterloom.operators import model
from meterloom.plans import standin
from meterloom.plans.registry import query, rounded, sql_round
from meterloom.plans.standin import COLS, PROFILE, ROLES, SHORT, SPLITS

FEATURES = feature_columns(ROLES)
TARGETS = target_columns()
FLAGS = [*SHORT, *PROFILE]
VALUES = [c for c in FEATURES if c not in FLAGS]
CLEANED = [feat.cleaned_name(c, ROLES) for c in COLS]
ORIGIN = "2024-01-28 12:00:00"
KEYS = ("meter_id", "hour")
# Shorter than the data's 720 hours, so that the row-level queries cross bucket borders.
BUCKET_HOURS = 240

_W = "WINDOW w AS (PARTITION BY meter_id ORDER BY hour)"


def _cleaned(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir)
    return feat.clip_columns(hourly, ROLES, feat.clip_bounds(hourly, COLS, SPLITS.val_start))


def _sql_window(columns: dict[str, str]) -> str:
    inner = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"""{standin.sql_cleaned()}, v AS (
SELECT meter_id, hour, {inner} FROM cleaned {_W})
SELECT meter_id, hour, {sql_round(list(columns))} FROM v"""


def _windowed(spark, sf_dir, columns, before, after=0):
    rows = feat.windowed(_cleaned(spark, sf_dir), columns, before, after, BUCKET_HOURS)
    return rounded(rows.select(*KEYS, *columns))


@query(
    "clip_percentile",
    f"{standin.sql_cleaned()} SELECT meter_id, hour, {sql_round(CLEANED)} FROM cleaned",
)
def clip_percentile(spark, sf_dir):
    return rounded(_cleaned(spark, sf_dir).select(*KEYS, *CLEANED))


_SQL_LAGS = {f"load_lag_{k}": f"lag(load_cleaned, {k}) OVER w" for k in TARGET_LAGS}
_SQL_EXOG_LAGS = {
    f"{c}_lag_{k}": f"lag({c}_cleaned, {k}) OVER w" for c in ROLES.exog for k in EXOG_LAGS
}
_SQL_MEANS = {f"rolling_mean_{w}": standin.sql_rolling("avg", "load_cleaned", w) for w in (24, 168)}
_SQL_STDS = {
    f"rolling_std_{w}": standin.sql_rolling("stddev_samp", "load_cleaned", w) for w in (24, 168)
}
_SQL_MIN_MAX = {
    f"rolling_{fn}_24": standin.sql_rolling(fn, "load_cleaned", 24) for fn in ("min", "max")
}
_SQL_EXOG_MEANS = {
    f"{c}_rolling_mean_24": standin.sql_rolling("avg", f"{c}_cleaned", 24) for c in ROLES.exog
}
_SQL_EWMA = {f"ewm_mean_{s}": standin.sql_ewma(s) for s in EWMA_SPANS}
_SQL_TARGETS = {f"target_h{h}": f"lead(load, {h}) OVER w" for h in range(1, 25)}


@query("lag_target", _sql_window(_SQL_LAGS))
def lag_target(spark, sf_dir):
    columns = {f"load_lag_{k}": feat.lag_of("load_cleaned", k) for k in TARGET_LAGS}
    return _windowed(spark, sf_dir, columns, max(TARGET_LAGS))


@query("lag_exog", _sql_window(_SQL_EXOG_LAGS))
def lag_exog(spark, sf_dir):
    columns = {
        f"{c}_lag_{k}": feat.lag_of(f"{c}_cleaned", k) for c in ROLES.exog for k in EXOG_LAGS
    }
    return _windowed(spark, sf_dir, columns, max(EXOG_LAGS))


def _rolling(spark, sf_dir, wanted):
    rows = feat.rolling(_cleaned(spark, sf_dir), wanted, bucket_hours=BUCKET_HOURS)
    return rounded(rows.select(*KEYS, *[w.name for w in wanted]))


@query("rolling_mean", _sql_window(_SQL_MEANS))
def rolling_mean(spark, sf_dir):
    wanted = [feat.Rolling(f"rolling_mean_{w}", "mean", "load_cleaned", w) for w in (24, 168)]
    return _rolling(spark, sf_dir, wanted)


@query("rolling_std", _sql_window(_SQL_STDS))
def rolling_std(spark, sf_dir):
    wanted = [feat.Rolling(f"rolling_std_{w}", "std", "load_cleaned", w) for w in (24, 168)]
    return _rolling(spark, sf_dir, wanted)


@query("rolling_min_max", _sql_window(_SQL_MIN_MAX))
def rolling_min_max(spark, sf_dir):
    wanted = [feat.Rolling(f"rolling_{fn}_24", fn, "load_cleaned", 24) for fn in ("min", "max")]
    return _rolling(spark, sf_dir, wanted)


@query("ewma", _sql_window(_SQL_EWMA))
def ewma(spark, sf_dir):
    rows = feat.ewma(_cleaned(spark, sf_dir), "load_cleaned", EWMA_SPANS, BUCKET_HOURS)
    return rounded(rows.select(*KEYS, *_SQL_EWMA))


@query("rolling_mean_exog", _sql_window(_SQL_EXOG_MEANS))
def rolling_mean_exog(spark, sf_dir):
    wanted = [
        feat.Rolling(f"{c}_rolling_mean_24", "mean", f"{c}_cleaned", 24) for c in ROLES.exog
    ]
    return _rolling(spark, sf_dir, wanted)


@query("lead_targets", _sql_window(_SQL_TARGETS))
def lead_targets(spark, sf_dir):
    return _windowed(spark, sf_dir, feat.lead_target_columns("load"), 0, 24)


_SQL_FEATURES = f"""{standin.sql_cleaned()}, feats AS (SELECT meter_id, hour, {", ".join(CLEANED)},
{", ".join(f"{sql} AS {n}" for part in (_SQL_LAGS, _SQL_EXOG_LAGS, _SQL_MEANS, _SQL_STDS,
    _SQL_MIN_MAX, _SQL_EWMA, _SQL_EXOG_MEANS, _SQL_TARGETS) for n, sql in part.items())},
{", ".join(FLAGS)} FROM cleaned {_W})"""
_SQL_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES + TARGETS)
_SQL_FEATURES_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)


def _sql_floats(columns) -> str:
    return ", ".join(
        f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 4) + 0.0 AS {c}" for c in columns
    )


@query(
    "complete_cases",
    f"""{_SQL_FEATURES} SELECT meter_id, hour, {sql_round(VALUES + TARGETS)}, {", ".join(FLAGS)}
FROM feats WHERE {_SQL_COMPLETE}""",
)
def complete_cases(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir)
    bounds = feat.clip_bounds(hourly, COLS, SPLITS.val_start)
    frame = feat.feature_frame(hourly, ROLES, bounds, bucket_hours=BUCKET_HOURS)
    return rounded(feat.complete_cases(frame, FEATURES + TARGETS))


@query(
    "feature_matrix",
    f"""{_SQL_FEATURES} SELECT meter_id, hour, {_sql_floats(VALUES + TARGETS)}, {", ".join(FLAGS)}
FROM feats WHERE {_SQL_COMPLETE}""",
)
def feature_matrix(spark, sf_dir):
    return rounded(feat.feature_matrix(standin.hourly(spark, sf_dir), ROLES, SPLITS.val_start), 4)


@query(
    "downcast_float32",
    f"""{standin.sql_cleaned()} SELECT meter_id, hour, {_sql_floats(CLEANED)} FROM cleaned""",
)
def downcast_float32(spark, sf_dir):
    return rounded(feat.downcast(_cleaned(spark, sf_dir).select(*KEYS, *CLEANED)), 4)


_PICKED = ["load_cleaned", "load_lag_24", "rolling_mean_168", "ewm_mean_24"]


@query(
    "select_features",
    f"{_SQL_FEATURES} SELECT meter_id, hour, {_sql_floats(_PICKED)} FROM feats WHERE {_SQL_COMPLETE}",
)
def select_features(spark, sf_dir):
    matrix = feat.feature_matrix(standin.hourly(spark, sf_dir), ROLES, SPLITS.val_start)
    return rounded(feat.select_features(matrix, _PICKED), 4)


@query(
    "horizon_long",
    f"""{_SQL_FEATURES}, long AS (UNPIVOT (SELECT meter_id, hour, {", ".join(TARGETS)} FROM feats
WHERE {_SQL_COMPLETE}) ON {", ".join(TARGETS)} INTO NAME name VALUE actual)
SELECT meter_id, hour, CAST(replace(name, 'target_h', '') AS INT) AS h,
round(CAST(CAST(actual AS FLOAT) AS DOUBLE), 4) AS actual FROM long""",
)
def horizon_long(spark, sf_dir):
    matrix = feat.feature_matrix(standin.hourly(spark, sf_dir), ROLES, SPLITS.val_start)
    return rounded(feat.horizon_long(matrix, KEYS), 4)


@query(
    "origin_features",
    f"""{_SQL_FEATURES} SELECT meter_id, hour, {_sql_floats(VALUES)}, {", ".join(FLAGS)}
FROM feats WHERE hour = TIMESTAMP '{ORIGIN}' AND {_SQL_FEATURES_PRESENT}""",
)
def origin_features(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir)
    bounds = feat.clip_bounds(hourly, COLS, SPLITS.val_start)
    return rounded(feat.origin_features(hourly, ROLES, ORIGIN, bounds), 4)


@query(
    "latest_origin_per_meter",
    f"""{_SQL_FEATURES} SELECT meter_id, hour, {_sql_floats(VALUES)}, {", ".join(FLAGS)}
FROM feats WHERE {_SQL_FEATURES_PRESENT}
QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY hour DESC) = 1""",
)
def latest_origin_per_meter(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir)
    bounds = feat.clip_bounds(hourly, COLS, SPLITS.val_start)
    frame = feat.feature_frame(hourly, ROLES, bounds, with_targets=False)
    return rounded(feat.downcast(feat.latest_origin(feat.complete_cases(frame, FEATURES))), 4)


@query(
    "append_future_rows",
    f"""{standin.sql_hourly("user_id")}, last AS (
SELECT meter_id, max(hour) AS hour FROM hourly GROUP BY meter_id)
SELECT meter_id, hour, {sql_round(COLS)} FROM hourly
UNION ALL SELECT meter_id, hour + to_hours(h), {", ".join("0.0" for _ in COLS)} FROM last,
  (SELECT CAST(unnest(range(1, 25)) AS INT) AS h)""",
)
def append_future_rows(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir, "user_id")
    return rounded(feat.append_future_rows(hourly, COLS))


@query(
    "align_on_time",
    f"""{standin.sql_readings()}, s AS (SELECT meter_id, date_trunc('hour', ts) AS hour,
sum(load) AS load FROM readings WHERE load IS NOT NULL GROUP BY 1, 2), m AS (
SELECT meter_id, date_trunc('hour', ts) AS hour, avg(voltage) AS voltage FROM readings
WHERE voltage IS NOT NULL GROUP BY 1, 2)
SELECT meter_id, hour, {sql_round(["load", "voltage"])} FROM s FULL JOIN m USING (meter_id, hour)""",
)
def align_on_time(spark, sf_dir):
    """Two hourly tables with different hours, aligned on meter and hour."""
    rows = standin.readings(spark, sf_dir)
    keyed = rows.withColumn("hour", truncate_hour(F.col("ts")))

    def hours(column, aggregate):
        present = keyed.filter(F.col(column).isNotNull())
        return present.groupBy(*KEYS).agg(aggregate(column).alias(column))

    return rounded(feat.align_on_time(hours("load", F.sum), hours("voltage", F.avg)))


@query(
    "ts_cv_folds",
    f"""{_SQL_FEATURES}, hours AS (SELECT DISTINCT hour FROM feats WHERE {_SQL_COMPLETE}
  AND hour < TIMESTAMP '{SPLITS.test_start}'),
ranked AS (SELECT hour, row_number() OVER (ORDER BY hour) - 1 AS rank, count(*) OVER () AS n FROM hours)
SELECT hour, CAST(rank AS BIGINT) AS rank, CAST(n AS BIGINT) AS n,
CAST(CASE WHEN rank < n - 3 * (n // 4) THEN 0
  WHEN rank < n - 2 * (n // 4) THEN 1 WHEN rank < n - (n // 4) THEN 2 ELSE 3 END AS INT) AS fold
FROM ranked""",
)
def ts_cv_folds(spark, sf_dir):
    matrix = feat.feature_matrix(standin.hourly(spark, sf_dir), ROLES, SPLITS.val_start)
    return model.ts_cv_folds(
        matrix.filter(F.col("hour") < F.lit(SPLITS.test_start).cast("timestamp_ntz"))
    )
