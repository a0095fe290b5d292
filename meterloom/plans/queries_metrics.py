"""Queries over baselines, accuracy metrics, error slices and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions import scalars
from meterloom.operators import baselines, metrics, reports
from meterloom.operators import features as feat
from meterloom.plans import standin
from meterloom.plans.forecasts import forecasts
from meterloom.plans.registry import query, rounded, sql_round
from meterloom.plans.standin import SPLITS

METHODS = ("point", *baselines.BASELINES)
ORIGIN = "2024-01-28 12:00:00"
# Origins in the test period: what there is of the week of seven days from its start.
WEEK = ("2024-01-26 00:00:00", "2024-02-01 23:00:00")
USERS = "user_id"

_F = standin.sql_forecasts()
_FU = standin.sql_forecasts(USERS)
_ERR = "(actual - point)"
_PCT = "abs((actual - {f}) / CASE WHEN actual = 0 THEN 1e-5 ELSE actual END) * 100"


def _at(time: str):
    return F.lit(time).cast("timestamp_ntz")


# -- baselines -----------------------------------------------------------------
def _naive(name: str, hours: int):
    sql = f"""{standin.sql_hourly(USERS)}, v AS (SELECT meter_id, hour, load,
lag(load, {hours}) OVER (PARTITION BY meter_id ORDER BY hour) AS {name} FROM hourly)
SELECT meter_id, hour, {sql_round(["load", name])} FROM v"""

    @query(name, sql)
    def run(spark, sf_dir):
        return rounded(baselines.naive_at(standin.hourly(spark, sf_dir, USERS, standin.LOAD), "load", hours, name))

    return run


naive_daily = _naive("naive_daily", 24)
naive_weekly = _naive("naive_weekly", 168)


@query(
    "rolling_avg_7d",
    f"""{standin.sql_hourly()}, v AS (SELECT meter_id, hour, load,
CASE WHEN lag(load, 167) OVER w IS NOT NULL
  THEN avg(load) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END AS rolling_avg_7d
FROM hourly WINDOW w AS (PARTITION BY meter_id ORDER BY hour))
SELECT meter_id, hour, {sql_round(["load", "rolling_avg_7d"])} FROM v""",
)
def rolling_avg_7d(spark, sf_dir):
    return rounded(baselines.rolling_average(standin.hourly(spark, sf_dir, roles=standin.LOAD), "load"))


@query(
    "baselines_long",
    f"""{_F} SELECT meter_id, origin, h, target_time,
{sql_round(["actual", "daily_naive", "weekly_naive", "rolling_avg_7d"])} FROM baselines""",
)
def baselines_long(spark, sf_dir):
    return rounded(
        baselines.baselines_long(standin.hourly(spark, sf_dir, roles=standin.LOAD), "load", SPLITS.test_start)
    )


@query(
    "repair_interval",
    f"""{_F}, r AS (SELECT meter_id, origin, h, point, least(daily_naive, point) AS lower,
greatest(rolling_avg_7d, point) AS upper FROM forecasts)
SELECT meter_id, origin, h, {sql_round(["point", "lower", "upper"])} FROM r""",
)
def repair_interval(spark, sf_dir):
    """The naive forecasts taken as raw bounds of the point."""
    rows = forecasts(spark, sf_dir)
    return rounded(
        rows.select(
            "meter_id",
            "origin",
            "h",
            "point",
            scalars.repaired_lower(F.col("daily_naive"), F.col("point")).alias("lower"),
            scalars.repaired_upper(F.col("rolling_avg_7d"), F.col("point")).alias("upper"),
        )
    )


# -- metrics, per meter and over all --------------------------------------------
_SQL_METRICS = {
    "mae": f"avg(abs{_ERR})",
    "rmse": f"sqrt(avg({_ERR} * {_ERR}))",
    "mape": f"avg({_PCT.format(f='point')})",
    "r2": f"1 - sum({_ERR} * {_ERR}) / nullif(var_pop(actual) * count(actual), 0)",
    "pinball_low": "avg(greatest((actual - lower) * 0.05, (actual - lower) * (0.05 - 1)))",
    "pinball_high": "avg(greatest((actual - upper) * 0.95, (actual - upper) * (0.95 - 1)))",
    "coverage": "avg(CASE WHEN actual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END) * 100",
    "mape_nonzero": "avg(CASE WHEN actual <> 0 THEN " + _PCT.format(f="point") + " END)",
}


def _per_meter(names: tuple[str, ...], digits: int = 6) -> str:
    inner = ", ".join(f"{_SQL_METRICS[n]} AS {n}" for n in names)
    return f"""{_FU}, m AS (SELECT meter_id, {inner} FROM forecasts GROUP BY meter_id)
SELECT meter_id, {sql_round(names, digits)} FROM m"""


def _metric(name: str, keys: tuple[str, ...], expressions, digits: int = 6) -> None:
    @query(name, _per_meter(keys, digits))
    def run(spark, sf_dir):
        columns = [e.alias(k) for k, e in zip(keys, expressions(), strict=True)]
        return rounded(forecasts(spark, sf_dir, USERS).groupBy("meter_id").agg(*columns), digits)


_Y, _P = "actual", "point"
_metric("metric_mae", ("mae",), lambda: [metrics.mae(F.col(_Y), F.col(_P))])
_metric("metric_rmse", ("rmse",), lambda: [metrics.rmse(F.col(_Y), F.col(_P))])
_metric(
    "metric_mape",
    ("mape", "mape_nonzero"),
    lambda: [
        metrics.mape(F.col(_Y), F.col(_P)),
        metrics.mape_nonzero(F.col(_Y), F.col(_P)),
    ],
    2,
)
_metric("metric_r2", ("r2",), lambda: [metrics.r2(F.col(_Y), F.col(_P))])
_metric(
    "metric_pinball",
    ("pinball_low", "pinball_high"),
    lambda: [
        F.avg(scalars.pinball(F.col(_Y), F.col("lower"), 0.05)),
        F.avg(scalars.pinball(F.col(_Y), F.col("upper"), 0.95)),
    ],
)
_metric(
    "metric_coverage",
    ("coverage",),
    lambda: [F.avg(scalars.covered(F.col(_Y), F.col("lower"), F.col("upper"))) * 100],
)


# -- slices ----------------------------------------------------------------------
_SQL_SLICED = f"""{_FU},
train AS (SELECT meter_id, median(load) AS train_median FROM hourly
  WHERE hour < TIMESTAMP '{SPLITS.val_start}' GROUP BY meter_id),
sliced AS (SELECT *, CAST(hour(target_time) AS INT) AS hour_of_day,
  CASE WHEN isodow(target_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  CASE WHEN month(target_time) IN (12, 1, 2) THEN 'Winter'
    WHEN month(target_time) IN (3, 4, 5) THEN 'Spring'
    WHEN month(target_time) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
  CASE WHEN actual <= train_median THEN 'Low-Load (<=Median)'
    WHEN actual > train_median THEN 'High-Load (>Median)' ELSE 'Unknown-Load' END AS load_level
  FROM forecasts LEFT JOIN train USING (meter_id))"""
_SQL_SLICE_METRICS = f"""round(avg(abs{_ERR}), 6) AS MAE, round(sqrt(avg({_ERR} * {_ERR})), 6) AS RMSE,
round(avg({_PCT.format(f="point")}), 2) AS MAPE"""


def _sliced(spark, sf_dir):
    hourly = standin.hourly_load(spark, sf_dir, USERS)
    # An hour unfolds into 24 forecasts, so its meter's median is joined before.
    known = hourly.join(metrics.train_median(hourly, "load", SPLITS.val_start), "meter_id", "left")
    return metrics.with_slices(forecasts(spark, sf_dir, USERS, known, ["train_median"]))


def _slice(name: str, dimension: str) -> None:
    sql = f"{_SQL_SLICED} SELECT {dimension}, {_SQL_SLICE_METRICS} FROM sliced GROUP BY {dimension}"

    @query(name, sql)
    def run(spark, sf_dir):
        return rounded(metrics.slice_by(_sliced(spark, sf_dir), dimension), MAPE=2)


_slice("slice_by_hour", "hour_of_day")
_slice("slice_by_day_type", "day_type")
_slice("slice_by_season", "season")
_slice("slice_by_load_level", "load_level")


@query(
    "robustness_report",
    f"""{_SQL_SLICED} """
    + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS bucket, {_SQL_SLICE_METRICS} "
        f"FROM sliced GROUP BY {d}"
        for d in ("hour_of_day", "day_type", "season", "load_level")
    ),
)
def robustness_report(spark, sf_dir):
    return rounded(metrics.robustness_report(_sliced(spark, sf_dir)), MAPE=2)


@query(
    "train_median",
    f"""{standin.sql_hourly(USERS)} SELECT meter_id, round(median(load), 6) AS train_median
FROM hourly WHERE hour < TIMESTAMP '{SPLITS.val_start}' GROUP BY meter_id""",
)
def train_median(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir, USERS, standin.LOAD)
    return rounded(metrics.train_median(hourly, "load", SPLITS.val_start))


# -- method tables -----------------------------------------------------------------
def _sql_method(m: str) -> str:
    e = f"(actual - {m})"
    return f"""SELECT '{m}' AS method, avg(abs{e}) AS MAE, sqrt(avg({e} * {e})) AS RMSE,
avg({_PCT.format(f=m)}) AS MAPE, 1 - sum({e} * {e}) / (var_pop(actual) * count(actual)) AS R2
FROM forecasts"""


_SQL_COMPARISON = f"{_FU}, comparison AS ({' UNION ALL '.join(_sql_method(m) for m in METHODS)})"


@query(
    "method_comparison",
    f"""{_SQL_COMPARISON} SELECT method, {sql_round(["MAE", "RMSE", "R2"])}, {sql_round(["MAPE"], 2)}
FROM comparison""",
)
def method_comparison(spark, sf_dir):
    table = metrics.method_comparison(forecasts(spark, sf_dir, USERS), METHODS)
    return rounded(table, MAPE=2)


@query(
    "improvement_vs_baseline",
    f"""{_SQL_COMPARISON}, g AS (SELECT c.method, (b.MAE - c.MAE) / b.MAE * 100 AS MAE_gain_pct,
(b.RMSE - c.RMSE) / b.RMSE * 100 AS RMSE_gain_pct, c.R2 - b.R2 AS R2_difference
FROM comparison c JOIN comparison b ON b.method = 'daily_naive')
SELECT method, {sql_round(["MAE_gain_pct", "RMSE_gain_pct", "R2_difference"])} FROM g""",
)
def improvement_vs_baseline(spark, sf_dir):
    table = metrics.method_comparison(forecasts(spark, sf_dir, USERS), METHODS)
    return rounded(metrics.improvement_vs_baseline(table))


# -- reports -------------------------------------------------------------------------
@query(
    "origin_window_kpi",
    f"""{_F} SELECT meter_id, origin, round(avg(abs{_ERR}), 6) AS MAE,
round(sqrt(avg({_ERR} * {_ERR})), 6) AS RMSE FROM forecasts
GROUP BY meter_id, origin HAVING count(actual) = 24""",
)
def origin_window_kpi(spark, sf_dir):
    return rounded(metrics.origin_window_kpi(forecasts(spark, sf_dir)))


_SQL_SPAN = f"""{_FU}, e AS (SELECT {_ERR} AS residual FROM forecasts),
span AS (SELECT min(residual) AS lo, max(residual) AS hi, count(*) AS n, avg(residual) AS mu,
  stddev_pop(residual) AS sigma FROM e)"""


@query(
    "residual_histogram",
    f"""{_SQL_SPAN}, b AS (SELECT least(floor((residual - lo) / ((hi - lo) / 60)), 59) AS bin
  FROM e, span), c AS (SELECT bin, count(*) AS n_bin FROM b GROUP BY bin),
bins AS (SELECT unnest(range(0, 60)) AS bin), j AS (SELECT CAST(bins.bin AS INT) AS bin,
  lo + (hi - lo) / 60 * bins.bin AS left_edge, lo + (hi - lo) / 60 * (bins.bin + 1) AS right_edge,
  CAST(coalesce(n_bin, 0) AS BIGINT) AS count,
  coalesce(n_bin, 0) / (n * ((hi - lo) / 60)) AS density
  FROM bins CROSS JOIN span LEFT JOIN c ON c.bin = bins.bin)
SELECT bin, count, {sql_round(["left_edge", "right_edge", "density"])} FROM j""",
)
def residual_histogram(spark, sf_dir):
    e = forecasts(spark, sf_dir, USERS).select((F.col("actual") - F.col("point")).alias("residual"))
    return rounded(reports.residual_histogram(e))


@query(
    "residual_normal_fit",
    f"""{_SQL_SPAN}, x AS (SELECT CAST(edge AS INT) AS edge, lo + (hi - lo) / 60 * edge AS x, mu, sigma
  FROM span, (SELECT unnest(range(0, 61)) AS edge)), d AS (SELECT *,
  1 / (sigma * sqrt(2 * pi())) * exp(-(x - mu) * (x - mu) / (2 * sigma * sigma)) AS density FROM x)
SELECT edge, {sql_round(["x", "mu", "sigma", "density"])} FROM d""",
)
def residual_normal_fit(spark, sf_dir):
    e = forecasts(spark, sf_dir, USERS).select((F.col("actual") - F.col("point")).alias("residual"))
    return rounded(reports.residual_normal_fit(e))


@query(
    "forecast_vs_actual",
    f"""{_F} SELECT meter_id, origin,
{sql_round(["actual", "point", "lower", "upper", "daily_naive"])} FROM forecasts
WHERE h = 1 AND origin BETWEEN TIMESTAMP '{WEEK[0]}' AND TIMESTAMP '{WEEK[1]}'""",
)
def forecast_vs_actual(spark, sf_dir):
    rows = forecasts(spark, sf_dir)
    return rounded(reports.forecast_vs_actual(rows, _at(WEEK[0]), _at(WEEK[1])))


@query(
    "forecast_detail",
    f"""{_F} SELECT meter_id, h, 't+' || h AS horizon,
strftime(target_time, '%Y-%m-%d %H:%M') AS timestamp, {sql_round(["lower", "point", "upper", "actual"])},
round(actual - point, 6) + 0.0 AS error FROM forecasts WHERE origin = TIMESTAMP '{ORIGIN}'""",
)
def forecast_detail(spark, sf_dir):
    return rounded(reports.forecast_detail(forecasts(spark, sf_dir), _at(ORIGIN)))


@query(
    "history_context",
    f"""{_F}, b AS (SELECT meter_id, 'history' AS series, hour AS time, load AS value FROM hourly
WHERE hour > TIMESTAMP '{ORIGIN}' - INTERVAL 24 HOUR AND hour <= TIMESTAMP '{ORIGIN}'
UNION ALL SELECT meter_id, 'forecast', target_time, point FROM forecasts
WHERE origin = TIMESTAMP '{ORIGIN}'), c AS (
SELECT *, max(value) OVER (PARTITION BY meter_id) AS ceiling FROM b)
SELECT meter_id, series, time, {sql_round(["value", "ceiling"])} FROM c""",
)
def history_context(spark, sf_dir):
    hourly = standin.hourly_load(spark, sf_dir)
    table = reports.history_context(hourly, forecasts(spark, sf_dir, hourly=hourly), "load", _at(ORIGIN))
    return rounded(table)


# Importance stand-in: how strongly a feature moves with the load h hours later.
_LAGS = {
    1: (1, 2, 3, 4, 5, 6, 12, 23, 24, 25, 36, 48, 72),
    24: (1, 12, 24, 25, 26, 47, 48, 49, 60, 72, 84, 96, 120, 144, 168),
}


def _sql_importance(h: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT 'load_lag_{k}' AS feature, abs(corr(y, x{k})) AS importance FROM p{h}"
        for k in _LAGS[h]
    )
    lags = ", ".join(f"lag(load, {k}) OVER w AS x{k}" for k in _LAGS[h])
    return f"""p{h} AS (SELECT lead(load, {h}) OVER w AS y, {lags} FROM hourly
WINDOW w AS (PARTITION BY meter_id ORDER BY hour)), i{h} AS ({rows})"""


_SQL_IMPORTANCE = f"{standin.sql_hourly(USERS)}, {_sql_importance(1)}, {_sql_importance(24)}"


def _importance(hourly, h):
    columns = {f"load_lag_{k}": feat.lag_of("load", k) for k in _LAGS[h]} | {"y": feat.lead_of("load", h)}
    rows = feat.windowed(hourly, columns, max(_LAGS[h]), h)
    wide = rows.agg(*[F.abs(F.corr("y", f"load_lag_{k}")).alias(f"load_lag_{k}") for k in _LAGS[h]])
    return wide.unpivot([], list(wide.columns), "feature", "importance")


@query(
    "join_outer_importance",
    f"""{_SQL_IMPORTANCE}, j AS (SELECT feature, a.importance AS importance_left,
b.importance AS importance_right FROM i1 a FULL JOIN i24 b USING (feature))
SELECT feature, {sql_round(["importance_left", "importance_right"])},
round((coalesce(importance_left, 0) + coalesce(importance_right, 0)) / (
  CAST(importance_left IS NOT NULL AS INT) + CAST(importance_right IS NOT NULL AS INT)), 6)
  AS mean_importance FROM j""",
)
def join_outer_importance(spark, sf_dir):
    hourly = standin.hourly_load(spark, sf_dir, USERS)
    left, right = _importance(hourly, 1), _importance(hourly, 24)
    return rounded(reports.join_outer_importance(left, right))


@query(
    "top_k",
    f"""{_SQL_IMPORTANCE}, u AS (SELECT * FROM i1 UNION ALL SELECT * FROM i24)
SELECT feature, round(avg(importance), 6) AS mean_importance FROM u GROUP BY feature
ORDER BY avg(importance) DESC, feature LIMIT 20""",
)
def top_k(spark, sf_dir):
    hourly = standin.hourly_load(spark, sf_dir, USERS)
    tables = [_importance(hourly, h) for h in _LAGS]
    return rounded(reports.top_k(reports.mean_importance(tables), "mean_importance", "feature"))


@query(
    "sample_origin",
    f"""{standin.sql_hourly()}, t AS (SELECT hour FROM hourly
WHERE hour >= TIMESTAMP '{SPLITS.test_start}')
SELECT hour FROM t WHERE hour <= (SELECT max(hour) FROM t) - INTERVAL 48 HOUR
ORDER BY md5('42' || strftime(hour, '%Y%m%d%H')), hour LIMIT 1""",
)
def sample_origin(spark, sf_dir):
    return reports.sample_origin(standin.hourly(spark, sf_dir, roles=standin.LOAD), SPLITS.test_start, "42")


@query(
    "origin_range",
    f"""{standin.sql_hourly(USERS)} SELECT meter_id, min(hour) AS first_origin,
max(hour) - INTERVAL 24 HOUR AS last_origin FROM hourly
WHERE hour >= TIMESTAMP '{SPLITS.test_start}' GROUP BY meter_id""",
)
def origin_range(spark, sf_dir):
    return reports.origin_range(standin.hourly(spark, sf_dir, USERS, standin.LOAD), SPLITS.test_start)
