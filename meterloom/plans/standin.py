"""The driver's ``events`` table read as meter readings, in Spark and as oracle SQL.

Events carry a ``value`` and a number ``k`` in ``props``. They stand for the seven
measurements of a meter; ``k`` and ``value`` also decide which measurement is missing.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterloom.config import Roles, Splits, profile_flag, short_flag
from meterloom.operators import gaps, profile, resample
from meterloom.session import scratch_path

ROLES = Roles(
    target="load",
    exog=("reactive", "voltage", "intensity", "sub_1", "sub_2", "sub_3"),
    sum_cols=("load", "sub_1", "sub_2", "sub_3"),
    mean_cols=("reactive", "voltage", "intensity"),
)
#: The load alone. Readings that tie in time and row_id are ordered by it first, so its gaps are the same.
LOAD = Roles(target="load", exog=(), sum_cols=("load",), mean_cols=())
SPLITS = Splits("2024-01-21 00:00:00", "2024-01-26 00:00:00")
MAX_GAP = 2
COLS = ROLES.all_cols
#: Intervals that the gap fill cuts a meter into: a day where few meters share all readings, else a month.
CHUNK_SECONDS = {"event_type": 86_400}
MONTH_SECONDS = 31 * 86_400
SHORT = [short_flag(c) for c in COLS]
PROFILE = [profile_flag(c) for c in COLS]

# ``value`` has two decimals; the factors keep means off exact halves, where the two engines
# may round differently.
_MEASUREMENTS = {
    "load": "CASE WHEN k >= 25 THEN value * 0.7310585786e0 END",
    "reactive": "CASE WHEN value >= 5 THEN value * 0.1192029221e0 END",
    "voltage": "CASE WHEN value >= 5 THEN 220 + k * 0.1428571429e0 END",
    "intensity": "CASE WHEN k < 90 THEN value * 0.2689414214e0 END",
    "sub_1": "CASE WHEN k >= 25 THEN CASE WHEN k < 50 THEN value * 0.7310585786e0 ELSE 0 END END",
    "sub_2": "CASE WHEN k >= 50 THEN CASE WHEN k < 75 THEN value * 0.7310585786e0 ELSE 0 END END",
    "sub_3": "CASE WHEN k >= 75 THEN value * 0.7310585786e0 END",
}


# -- Spark -------------------------------------------------------------------
def readings(spark: SparkSession, sf_dir: str, meter: str = "event_type") -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    with_k = events.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))
    return with_k.select(
        F.col(meter).cast("string").alias("meter_id"),
        "ts",
        F.col("event_id").alias("row_id"),
        *[F.expr(sql).cast("double").alias(c) for c, sql in _MEASUREMENTS.items()],
    )


def filled(spark: SparkSession, sf_dir: str, meter: str = "event_type", roles: Roles = ROLES) -> DataFrame:
    columns = roles.all_cols
    rows = readings(spark, sf_dir, meter).select("meter_id", "ts", "row_id", *columns)
    return gaps.interpolate_short_gaps(rows, columns, MAX_GAP, seconds=CHUNK_SECONDS.get(meter, MONTH_SECONDS))


def raw_hourly(spark: SparkSession, sf_dir: str, meter: str = "event_type", roles: Roles = ROLES) -> DataFrame:
    bounds = resample.meter_bounds(readings(spark, sf_dir, meter))
    return resample.resample_hourly(filled(spark, sf_dir, meter, roles), roles, bounds=bounds)


def hourly(spark: SparkSession, sf_dir: str, meter: str = "event_type", roles: Roles = ROLES) -> DataFrame:
    """Written before the profile is taken from it and joined to it: the gap fill runs once.

    Spark prunes no column across the write, so a caller that uses the load alone says so by ``roles=LOAD``.
    """
    return _imputed(spark, sf_dir, meter, roles)[0]


def _imputed(spark: SparkSession, sf_dir: str, meter: str, roles: Roles) -> tuple[DataFrame, list[str]]:
    """The hourly table, and which columns had nulls to fill: they are counted as the raw hours are written."""
    path = scratch_path(spark, "raw-hourly")
    nulls = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in roles.all_cols]
    raw_hourly(spark, sf_dir, meter, roles).observe(nulls, *counts).write.parquet(path)
    lacking = [c for c in roles.all_cols if nulls.get[c]]
    return profile.profile_impute(spark.read.parquet(path), roles.all_cols, SPLITS.val_start, lacking), lacking


def hourly_load(spark: SparkSession, sf_dir: str, meter: str = "event_type") -> DataFrame:
    """The load of the hourly table, for queries that read it more than once.

    It is written again only if the profile filled some of it; else the stored raw hours are what it reads.
    """
    table, lacking = _imputed(spark, sf_dir, meter, LOAD)
    load = table.select("meter_id", "hour", "load")
    if not lacking:
        return load
    path = scratch_path(spark, "hourly-load")
    load.write.parquet(path)
    return spark.read.parquet(path)


# -- the same in SQL ---------------------------------------------------------
def _each(template: str, columns=COLS, sep: str = ",\n  ") -> str:
    return sep.join(template.replace("{c}", c) for c in columns)


@lru_cache
def sql_readings(meter: str = "event_type") -> str:
    measured = ",\n  ".join(f"CAST({sql} AS DOUBLE) AS {c}" for c, sql in _MEASUREMENTS.items())
    return f"""WITH readings AS (
  SELECT CAST({meter} AS VARCHAR) AS meter_id, ts, event_id AS row_id,
  {measured}
  FROM (SELECT *, CAST(props->>'$.k' AS DOUBLE) AS k FROM events) e)"""


@lru_cache
def sql_filled(meter: str = "event_type") -> str:
    anchors = _each(
        """max(CASE WHEN {c} IS NOT NULL THEN rn END) OVER (w ROWS UNBOUNDED PRECEDING) AS p_{c},
  min(CASE WHEN {c} IS NOT NULL THEN rn END)
    OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n_{c},
  last_value({c} IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS pv_{c},
  first_value({c} IGNORE NULLS)
    OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv_{c}"""
    )
    short = (
        "({c} IS NULL AND coalesce(n_{c}, total + 1) - coalesce(p_{c}, 0) - 1 <= "
        + str(MAX_GAP)
        + ")"
    )
    values = _each(
        "CASE WHEN " + short + " THEN coalesce(pv_{c} + (nv_{c} - pv_{c}) * (rn - p_{c})"
        " / (n_{c} - p_{c}), pv_{c}) ELSE {c} END AS {c}"
    )
    flags = _each("CAST(" + short + " AS INT) AS {c}_is_short_imputed")
    return f"""{sql_readings(meter)},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY ts, row_id) AS rn,
    count(*) OVER (PARTITION BY meter_id) AS total FROM readings),
anchors AS (
  SELECT *, {anchors}
  FROM numbered WINDOW w AS (PARTITION BY meter_id ORDER BY rn)),
filled AS MATERIALIZED (SELECT meter_id, ts, row_id, {values},
  {flags} FROM anchors)"""


@lru_cache
def sql_raw_hourly(meter: str = "event_type") -> str:
    sums = _each("sum({c}) AS {c}", ROLES.sum_cols)
    means = _each("avg({c}) AS {c}", ROLES.mean_cols)
    flags = _each("max({c}_is_short_imputed) AS {c}_is_short_imputed")
    zero = _each("coalesce({c}, 0) AS {c}", ROLES.sum_cols)
    plain = _each("{c}", ROLES.mean_cols)
    no_flag = _each("coalesce({c}_is_short_imputed, 0) AS {c}_is_short_imputed")
    return f"""{sql_filled(meter)},
bounds AS (
  SELECT meter_id, date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi
  FROM readings GROUP BY meter_id),
spine AS (
  SELECT meter_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM bounds),
hour_agg AS (
  SELECT meter_id, date_trunc('hour', ts) AS hour, {sums}, {means}, {flags}
  FROM filled GROUP BY 1, 2),
raw_hourly AS (
  SELECT meter_id, hour, {zero}, {plain}, {no_flag}
  FROM spine LEFT JOIN hour_agg USING (meter_id, hour))"""


@lru_cache
def sql_hourly(meter: str = "event_type") -> str:
    medians = _each("median({c}) AS {c}_profile")
    values = _each(
        "coalesce({c}, {c}_profile) AS {c}, CAST({c} IS NULL AS INT) AS {c}_is_profile_imputed"
    )
    flags = _each("{c}_is_short_imputed")
    return f"""{sql_raw_hourly(meter)},
slotted AS (
  SELECT *, isodow(hour) - 1 AS dayofweek, hour(hour) AS hour_of_day FROM raw_hourly),
profile AS (
  SELECT meter_id, dayofweek, hour_of_day, {medians}
  FROM slotted WHERE hour < TIMESTAMP '{SPLITS.val_start}' GROUP BY 1, 2, 3),
hourly AS MATERIALIZED (
  SELECT meter_id, hour, {values}, {flags}
  FROM slotted LEFT JOIN profile USING (meter_id, dayofweek, hour_of_day))"""


@lru_cache
def sql_cleaned(meter: str = "event_type") -> str:
    bounds = _each("quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi")
    values = ",\n  ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}_lo), {c}_hi) END AS "
        f"{'load' if c == ROLES.target else c}_cleaned"
        for c in COLS
    )
    return f"""{sql_hourly(meter)},
clip_bounds AS (
  SELECT meter_id, {bounds} FROM hourly
  WHERE hour < TIMESTAMP '{SPLITS.val_start}' GROUP BY meter_id),
cleaned AS (SELECT hourly.*, {values} FROM hourly LEFT JOIN clip_bounds USING (meter_id))"""


def sql_ewma(span: int, column: str = "load_cleaned") -> str:
    a = 2.0 / (span + 1)
    return (
        f"list_reduce(list({column}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        f"lambda acc, v: acc * {1 - a!r} + v * {a!r})"
    )


def sql_rolling(fn: str, column: str, rows: int) -> str:
    frame = f"(w ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"
    return (
        f"CASE WHEN count({column}) OVER {frame} = {rows} THEN {fn}({column}) OVER {frame} END"
    )


def sql_forecasts(meter: str = "event_type") -> str:
    """``forecasts``: test origins x 24 steps with baselines and a simple point and band."""
    return f"""{sql_hourly(meter)},
origins AS (
  SELECT meter_id, hour AS origin,
    CASE WHEN lag(load, 167) OVER w IS NOT NULL
      THEN avg(load) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END AS rolling_avg_7d,
    stddev_samp(load) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS spread,
    lead(load, 24) OVER w AS last_target
  FROM hourly WINDOW w AS (PARTITION BY meter_id ORDER BY hour)),
grid AS MATERIALIZED (
  SELECT *, origin + to_hours(h) AS target_time, origin + to_hours(h - 24) AS day_before,
    origin + to_hours(h - 168) AS week_before
  FROM origins, (SELECT CAST(unnest(range(1, 25)) AS INT) AS h)
  WHERE origin >= TIMESTAMP '{SPLITS.test_start}'
    AND rolling_avg_7d IS NOT NULL AND last_target IS NOT NULL),
baselines AS MATERIALIZED (
  SELECT g.meter_id, g.origin, g.h, g.target_time, a.load AS actual,
    d.load AS daily_naive, w.load AS weekly_naive, g.rolling_avg_7d, g.spread
  FROM grid g
  JOIN hourly a ON a.meter_id = g.meter_id AND a.hour = g.target_time
  JOIN hourly d ON d.meter_id = g.meter_id AND d.hour = g.day_before
  JOIN hourly w ON w.meter_id = g.meter_id AND w.hour = g.week_before),
forecasts AS (
  SELECT *, (daily_naive + weekly_naive) / 2 AS point,
    (daily_naive + weekly_naive) / 2 - 1.645 * spread AS lower,
    (daily_naive + weekly_naive) / 2 + 1.645 * spread AS upper FROM baselines)"""
