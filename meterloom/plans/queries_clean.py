"""Queries over scalar functions, the calendar, gap handling and resampling."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from meterloom.functions import calendar as cal
from meterloom.functions import scalars
from meterloom.operators import gaps, metrics, profile, reports, resample
from meterloom.plans import forecasts, standin
from meterloom.plans.registry import query, rounded, sql_round
from meterloom.plans.standin import COLS, MAX_GAP, PROFILE, ROLES, SHORT, SPLITS

_TS = "timestamp_ntz"


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


# -- predicates and scalar functions ------------------------------------------
@query(
    "split_chronological",
    f"""SELECT event_id, ts, CASE WHEN ts < TIMESTAMP '{SPLITS.val_start}' THEN 'train'
WHEN ts < TIMESTAMP '{SPLITS.test_start}' THEN 'val' ELSE 'test' END AS split FROM events""",
)
def split_chronological(spark, sf_dir):
    label = scalars.split_label(F.col("ts"), SPLITS.val_start, SPLITS.test_start)
    return _events(spark, sf_dir).select("event_id", "ts", label.alias("split"))


@query(
    "time_slice",
    f"""{standin.sql_hourly()} SELECT meter_id, hour, {sql_round(["load"])} FROM hourly
WHERE hour BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-14 23:00:00'""",
)
def time_slice(spark, sf_dir):
    start = F.lit("2024-01-08 00:00:00").cast(_TS)
    end = F.lit("2024-01-14 23:00:00").cast(_TS)
    table = standin.hourly(spark, sf_dir).select("meter_id", "hour", "load")
    return rounded(reports.time_slice(table, start, end))


@query(
    "target_time",
    """SELECT o_orderkey, h, o_orderdate + to_hours(h) AS target_time
FROM orders, (SELECT CAST(unnest([1, 12, 24]) AS INT) AS h)""",
)
def target_time(spark, sf_dir):
    steps = F.explode(F.array(*[F.lit(h) for h in (1, 12, 24)])).alias("h")
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", steps)
    return rows.select("o_orderkey", "h", cal.add_hours(F.col("o_orderdate"), F.col("h")).alias("target_time"))


@query(
    "calendar_parts",
    """SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS dayofweek,
CAST(month(ts) AS INT) AS month, CAST(dayofyear(ts) AS INT) AS dayofyear FROM events""",
)
def calendar_parts(spark, sf_dir):
    parts = [cal.calendar_part(p, F.col("ts")).alias(p) for p in cal.CYCLES]
    return _events(spark, sf_dir).select("event_id", *parts)


@query(
    "is_weekend",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) >= 6 AS INT) AS is_weekend,
CASE WHEN isodow(o_orderdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM orders""",
)
def is_weekend(spark, sf_dir):
    at = F.col("o_orderdate")
    return _orders(spark, sf_dir).select(
        "o_orderkey", cal.is_weekend(at).alias("is_weekend"), cal.day_type(at).alias("day_type")
    )


_SQL_PARTS = {
    "hour": "hour(ts)",
    "dayofweek": "(isodow(ts) - 1)",
    "month": "month(ts)",
    "dayofyear": "dayofyear(ts)",
}
_CYCLE_NAMES = [f"{p}_{fn}" for p in cal.CYCLES for fn in ("sin", "cos")]


def _sql_cycles(ts: str) -> str:
    return ", ".join(
        f"CAST({fn}({2 * math.pi!r} * {_SQL_PARTS[p].replace('ts', ts)} / {cal.CYCLES[p]!r})"
        f" AS FLOAT) AS {p}_{fn}"
        for p in cal.CYCLES
        for fn in ("sin", "cos")
    )


@query(
    "cyclical_encode",
    f"""SELECT event_id, {sql_round(_CYCLE_NAMES)} FROM (
SELECT event_id, {_sql_cycles("ts")} FROM events)""",
)
def cyclical_encode(spark, sf_dir):
    cycles = [
        cal.cyclical(p, fn, F.col("ts")).alias(f"{p}_{fn}")
        for p in cal.CYCLES
        for fn in ("sin", "cos")
    ]
    return rounded(_events(spark, sf_dir).select("event_id", *cycles))


@query(
    "calendar_categories",
    """SELECT CAST(hour(ts) AS INT) AS hour_cat, CAST(isodow(ts) - 1 AS INT) AS dayofweek_cat,
CAST(month(ts) AS INT) AS month_cat, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2, 3""",
)
def calendar_categories(spark, sf_dir):
    block = {c: e for c, e in zip(cal.CALENDAR_COLUMNS, cal.calendar_block(F.col("ts")), strict=True)}
    names = ("hour_cat", "dayofweek_cat", "month_cat")
    rows = _events(spark, sf_dir).select(*[block[c] for c in names])
    return rows.groupBy(*names).agg(F.count("*").alias("n"))


SQL_EASTER = """years AS (SELECT CAST(unnest(range(1990, 2031)) AS INT) AS y),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS hh FROM e1),
e3 AS (SELECT *, (32 + 2*(b%4) + 2*(c//4) - hh - c%4) % 7 AS l FROM e2),
e4 AS (SELECT *, (a + 11*hh + 22*l) // 451 AS m FROM e3),
easter AS (SELECT y, make_date(y, (hh + l - 7*m + 114) // 31, (hh + l - 7*m + 114) % 31 + 1) AS d
  FROM e4),
holidays AS (
  SELECT d + CAST(unnest([1, 39, 50]) AS INT) AS holiday FROM easter
  UNION SELECT make_date(y, CAST(md // 100 AS INT), CAST(md % 100 AS INT)) FROM years,
    (SELECT unnest([101, 501, 508, 714, 815, 1101, 1111, 1225]) AS md))"""


@query(
    "holiday_flag",
    f"""WITH {SQL_EASTER} SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
CAST(CAST(o_orderdate AS DATE) IN (SELECT holiday FROM holidays) AS INT) AS is_holiday FROM orders""",
)
def holiday_flag(spark, sf_dir):
    at = F.col("o_orderdate")
    return _orders(spark, sf_dir).select(
        "o_orderkey", at.cast("date").cast("string").alias("day"), cal.is_holiday(at).alias("is_holiday")
    )


_SQL_SEASON = """CASE WHEN month({t}) IN (12, 1, 2) THEN 'Winter'
WHEN month({t}) IN (3, 4, 5) THEN 'Spring' WHEN month({t}) IN (6, 7, 8) THEN 'Summer'
ELSE 'Autumn' END"""


@query(
    "season_label",
    f"SELECT o_orderkey, {_SQL_SEASON.replace('{t}', 'o_orderdate')} AS season FROM orders",
)
def season_label(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", cal.season(F.col("o_orderdate")).alias("season"))


_SQL_MEDIAN = f"""train AS (SELECT meter_id, median(load) AS train_median FROM hourly
WHERE hour < TIMESTAMP '{SPLITS.val_start}' GROUP BY meter_id)"""


@query(
    "load_level_label",
    f"""{standin.sql_hourly()}, {_SQL_MEDIAN} SELECT meter_id, hour, {sql_round(["load"])},
CASE WHEN load <= train_median THEN 'Low-Load (<=Median)'
WHEN load > train_median THEN 'High-Load (>Median)' ELSE 'Unknown-Load' END
AS load_level FROM hourly LEFT JOIN train USING (meter_id)""",
)
def load_level_label(spark, sf_dir):
    hourly = standin.hourly(spark, sf_dir).select("meter_id", "hour", "load")
    medians = metrics.train_median(hourly, "load", SPLITS.val_start)
    level = scalars.load_level(F.col("load"), F.col("train_median"))
    return rounded(
        hourly.join(medians, "meter_id", "left").select("meter_id", "hour", "load", level.alias("load_level"))
    )


@query(
    "safe_divide",
    f"""{standin.sql_hourly()} SELECT meter_id, hour,
round(CASE WHEN load = 0 THEN 1e-5 ELSE load END, 6) AS denominator,
round(abs((load - 1) / CASE WHEN load = 0 THEN 1e-5 ELSE load END) * 100, 4) AS error_pct FROM hourly""",
)
def safe_divide(spark, sf_dir):
    load = F.col("load")
    rows = standin.hourly(spark, sf_dir).select(
        "meter_id",
        "hour",
        scalars.safe_denominator(load).alias("denominator"),
        scalars.percentage_error(load, F.lit(1.0)).alias("error_pct"),
    )
    return rounded(rows, error_pct=4)


@query(
    "format_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
strftime(ts, '%Y-%m-%d %H:%M') AS minute, 't+' || hour(ts) AS label FROM events""",
)
def format_time(spark, sf_dir):
    at = F.col("ts")
    return _events(spark, sf_dir).select(
        "event_id",
        scalars.iso_time(at).alias("iso"),
        scalars.minute_time(at).alias("minute"),
        scalars.horizon_label(F.hour(at)).alias("label"),
    )


@query(
    "residual",
    f"""{standin.sql_forecasts()}, e AS (SELECT meter_id, origin, h, actual - point AS residual,
abs(actual - point) AS ae, (actual - point) * (actual - point) AS se FROM forecasts)
SELECT meter_id, origin, h, {sql_round(["residual", "ae", "se"])} FROM e""",
)
def residual(spark, sf_dir):
    e = scalars.residual(F.col("actual"), F.col("point"))
    rows = forecasts.forecasts(spark, sf_dir)
    return rounded(
        rows.select(
            "meter_id", "origin", "h", e.alias("residual"), F.abs(e).alias("ae"), (e * e).alias("se")
        )
    )


# -- gaps and resampling -------------------------------------------------------
_SQL_ISLANDS = ", ".join(
    f"""CAST(island_{c} AS BIGINT) AS island_{c}, CAST(count(*) OVER (PARTITION BY meter_id, island_{c})
  - count({c}) OVER (PARTITION BY meter_id, island_{c}) AS BIGINT) AS gap_{c}"""
    for c in COLS
)


@query(
    "gap_islands",
    f"""{standin.sql_readings()}, i AS (SELECT *, {", ".join(f"""count({c})
  OVER (PARTITION BY meter_id ORDER BY ts, row_id ROWS UNBOUNDED PRECEDING) AS island_{c}""" for c in COLS)}
FROM readings) SELECT meter_id, row_id, {sql_round(COLS)}, {_SQL_ISLANDS} FROM i""",
)
def gap_islands(spark, sf_dir):
    return rounded(gaps.gap_islands_of(standin.readings(spark, sf_dir), COLS).drop("ts"))


@query(
    "interpolate_short_gaps",
    f"""{standin.sql_filled()} SELECT meter_id, ts, row_id, {sql_round(COLS)}, {", ".join(SHORT)}
FROM filled""",
)
def interpolate_short_gaps(spark, sf_dir):
    return rounded(standin.filled(spark, sf_dir))


@query(
    "short_gap_flag",
    f"""{standin.sql_filled("user_id")} SELECT meter_id, row_id, {", ".join(SHORT)} FROM filled""",
)
def short_gap_flag(spark, sf_dir):
    flagged = gaps.short_gap_flags(standin.readings(spark, sf_dir, "user_id"), COLS, MAX_GAP)
    return flagged.select("meter_id", "row_id", *SHORT)


_SUMS, _MEANS = list(ROLES.sum_cols), list(ROLES.mean_cols)


def _sql_hour_agg(fn: str, columns: list[str], empty: str) -> str:
    aggregates = ", ".join(f"{fn}({c}) AS {c}" for c in columns)
    values = ", ".join(empty.format(c=c) for c in columns)
    return f"""{standin.sql_raw_hourly("user_id")}, a AS (SELECT meter_id, date_trunc('hour', ts) AS hour,
{aggregates} FROM readings GROUP BY 1, 2), z AS (
SELECT meter_id, hour, {values} FROM spine LEFT JOIN a USING (meter_id, hour))
SELECT meter_id, hour, {sql_round(columns)} FROM z"""


@query("resample_sum_hourly", _sql_hour_agg("sum", _SUMS, "coalesce(a.{c}, 0) AS {c}"))
def resample_sum_hourly(spark, sf_dir):
    return rounded(resample.resample_sum(standin.readings(spark, sf_dir, "user_id"), _SUMS))


@query("resample_mean_hourly", _sql_hour_agg("avg", _MEANS, "a.{c} AS {c}"))
def resample_mean_hourly(spark, sf_dir):
    return rounded(resample.resample_mean(standin.readings(spark, sf_dir, "user_id"), _MEANS))


@query(
    "resample_flag_max",
    f"""{standin.sql_raw_hourly()} SELECT meter_id, hour, {", ".join(SHORT)} FROM raw_hourly""",
)
def resample_flag_max(spark, sf_dir):
    bounds = resample.meter_bounds(standin.readings(spark, sf_dir))
    return resample.resample_max_flag(standin.filled(spark, sf_dir), SHORT, bounds).select(
        "meter_id", "hour", *SHORT
    )


@query(
    "hourly_spine",
    f"""{standin.sql_raw_hourly("user_id")} SELECT meter_id, hour FROM spine""",
)
def hourly_spine(spark, sf_dir):
    return resample.hourly_spine(resample.meter_bounds(standin.readings(spark, sf_dir, "user_id")))


_PROFILES = [f"{c}_profile" for c in COLS]


@query(
    "seasonal_profile",
    f"""{standin.sql_hourly()} SELECT meter_id, CAST(dayofweek AS INT) AS dayofweek,
CAST(hour_of_day AS INT) AS hour_of_day, {sql_round(_PROFILES)} FROM profile""",
)
def seasonal_profile(spark, sf_dir):
    table = standin.raw_hourly(spark, sf_dir)
    return rounded(profile.seasonal_profile(table, COLS, SPLITS.val_start))


@query(
    "profile_impute",
    f"""{standin.sql_hourly()} SELECT meter_id, hour, {sql_round(COLS)}, {", ".join(SHORT)},
{", ".join(PROFILE)} FROM hourly""",
)
def profile_impute(spark, sf_dir):
    return rounded(standin.hourly(spark, sf_dir))


@query(
    "join_left_profile",
    f"""{standin.sql_hourly("user_id")} SELECT meter_id, CAST(count(*) AS BIGINT) AS hours,
{", ".join(f"CAST(count({p}) AS BIGINT) AS {p}_n, round(sum({p}), 4) AS {p}_sum" for p in _PROFILES)}
FROM slotted LEFT JOIN profile USING (meter_id, dayofweek, hour_of_day) GROUP BY meter_id""",
)
def join_left_profile(spark, sf_dir):
    table = standin.raw_hourly(spark, sf_dir, "user_id")
    joined = profile.join_profile(table, profile.seasonal_profile(table, COLS, SPLITS.val_start))
    sums = [e for p in _PROFILES for e in (F.count(p).alias(f"{p}_n"), F.sum(p).alias(f"{p}_sum"))]
    return rounded(joined.groupBy("meter_id").agg(F.count("*").alias("hours"), *sums), 4)


@query(
    "missing_counts",
    f"""{standin.sql_raw_hourly("user_id")} """
    + " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS missing FROM raw_hourly'
        for c in COLS
    ),
)
def missing_counts(spark, sf_dir):
    return profile.missing_counts(standin.raw_hourly(spark, sf_dir, "user_id"), COLS)


@query(
    "sort_chronological",
    f"""{standin.sql_readings()} SELECT meter_id, ts, row_id, CAST(row_number()
OVER (PARTITION BY meter_id ORDER BY ts, row_id) AS BIGINT) AS position FROM readings""",
)
def sort_chronological(spark, sf_dir):
    """Time order within each meter, shown as a position."""
    rows = standin.readings(spark, sf_dir).select("meter_id", "ts", "row_id", "load")
    return gaps.in_time_order(rows).select("meter_id", "ts", "row_id", "position").orderBy(
        "meter_id", "ts", "row_id"
    )


