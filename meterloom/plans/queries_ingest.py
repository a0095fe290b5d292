"""Queries over sources and sinks: text ingest, hourly cache, requests, runs."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.calendar import truncate_day
from meterloom.config import MIN_HISTORY, feature_columns
from meterloom.operators import gaps, metrics, scoring
from meterloom.plans import forecasts, standin
from meterloom.plans.registry import query, rounded, sql_round
from meterloom.plans.standin import COLS, PROFILE, ROLES, SHORT
from meterloom.session import scratch_path
from meterloom.sources import hourly_table, readings, requests, runs

TEXT_COLUMNS = ("row_id", "meter_id", "Date", "Time", "load", "level")
ORIGIN = "2024-01-28 12:00:00"


# -- delimited text ----------------------------------------------------------
# Every event as a text record: '?' where the value is missing, an empty or 'nan' level, and
# an impossible date where k is 13.
@lru_cache
def text_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "readings-text")
    k = F.get_json_object("props", "$.k").try_cast("int")
    (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("k", k)
        .select(
            F.col("event_id").cast("string").alias("row_id"),
            F.col("event_type").alias("meter_id"),
            F.when(F.col("k") == 13, "31/02/2024")
            .otherwise(F.date_format("ts", "d/M/yyyy"))
            .alias("Date"),
            F.date_format("ts", "H:mm:ss").alias("Time"),
            F.when(F.col("k") < 25, "?").otherwise(F.col("value").cast("string")).alias("load"),
            F.when(F.col("k") < 10, "")
            .when(F.col("k") < 20, "nan")
            .otherwise(F.concat(F.lit(" "), F.col("k").cast("string"), F.lit(".5 ")))
            .alias("level"),
        )
        .write.csv(path, sep=";", header=True, emptyValue="", ignoreLeadingWhiteSpace=False,
                   ignoreTrailingWhiteSpace=False)
    )
    return path


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.scan_delimited(spark, text_path(spark, sf_dir), TEXT_COLUMNS)


_SQL_TEXT = """WITH e AS (SELECT *, CAST(props->>'$.k' AS INT) AS k FROM events),
text AS (SELECT CAST(event_id AS VARCHAR) AS row_id, event_type AS meter_id,
  CASE WHEN k = 13 THEN '31/02/2024' ELSE strftime(ts, '%-d/%-m/%Y') END AS Date,
  strftime(ts, '%-H:%M:%S') AS Time,
  CASE WHEN k < 25 THEN '?' ELSE CAST(value AS VARCHAR) END AS load,
  CASE WHEN k < 10 THEN NULL WHEN k < 20 THEN 'nan' ELSE ' ' || k || '.5 ' END AS level FROM e),
timed AS (SELECT row_id, meter_id, try_strptime(Date || ' ' || Time, '%d/%m/%Y %H:%M:%S') AS ts,
  load, level FROM text)"""


@query("scan_delimited", f"{_SQL_TEXT} SELECT * FROM text")
def scan_delimited(spark, sf_dir):
    return _text(spark, sf_dir)


@query("parse_event_time", f"{_SQL_TEXT} SELECT * FROM timed WHERE ts IS NOT NULL")
def parse_event_time(spark, sf_dir):
    return readings.parse_event_time(_text(spark, sf_dir))


@query(
    "coerce_numeric",
    f"""{_SQL_TEXT}, num AS (
SELECT row_id, TRY_CAST(trim(load) AS FLOAT) AS load,
  CASE WHEN NOT isnan(TRY_CAST(trim(level) AS FLOAT)) THEN TRY_CAST(trim(level) AS FLOAT) END AS level
FROM text) SELECT row_id, {sql_round(["load", "level"])} FROM num""",
)
def coerce_numeric(spark, sf_dir):
    typed = readings.coerce_numeric(_text(spark, sf_dir), ["load", "level"])
    return rounded(typed.select("row_id", "load", "level"))


# -- hourly table ------------------------------------------------------------
@lru_cache
def _hourly_path(spark: SparkSession, sf_dir: str) -> str:
    return scratch_path(spark, "hourly")


@query(
    "hourly_table_cache",
    f"""{standin.sql_hourly()} SELECT meter_id, hour, {sql_round(COLS)},
{", ".join(SHORT)}, {", ".join(PROFILE)} FROM hourly""",
)
def hourly_table_cache(spark, sf_dir):
    def build() -> DataFrame:
        return standin.hourly(spark, sf_dir)

    path = _hourly_path(spark, sf_dir)
    hourly_table.hourly_table(spark, path, build)
    return rounded(hourly_table.hourly_table(spark, path, build))


# -- requests ----------------------------------------------------------------
def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings as JSON requests of at most 168 consecutive readings of one user."""
    rows = gaps.in_time_order(standin.readings(spark, sf_dir, "user_id"))
    part = F.floor((F.col("position") - 1) / MIN_HISTORY)
    entry = F.struct(
        F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")).alias("timestamp"),
        *[F.col(c) for c in COLS],
    )
    nested = rows.groupBy("meter_id", part.alias("part")).agg(F.collect_list(entry).alias("history"))
    good = nested.select(F.to_json(F.struct("meter_id", "history")).alias("request"))
    # Each user also sends a request without readings and one with a time that does not parse.
    users = standin.readings(spark, sf_dir, "user_id").select("meter_id").distinct()
    start = F.concat(F.lit('{"meter_id":"'), F.col("meter_id"))
    empty = users.select(F.concat(start, F.lit('"}')).alias("request"))
    bad = users.select(F.concat(start, F.lit('","history":[{"timestamp":"soon","load":1.5}]}')).alias("request"))
    return good.unionAll(empty).unionAll(bad)


@query(
    "request_explode",
    f"""{standin.sql_readings("user_id")}
SELECT meter_id, ts, {sql_round(COLS)} FROM readings
UNION ALL SELECT DISTINCT meter_id, CAST(NULL AS TIMESTAMP), {", ".join("CAST(NULL AS DOUBLE)" for _ in COLS)} FROM readings
UNION ALL SELECT DISTINCT meter_id, CAST(NULL AS TIMESTAMP), CAST(1.5 AS DOUBLE),
{", ".join("CAST(NULL AS DOUBLE)" for _ in COLS[1:])} FROM readings""",
)
def request_explode(spark, sf_dir):
    return rounded(requests.request_explode(_requests(spark, sf_dir), ROLES).drop("request_id"))


@query(
    "request_nest",
    f"""{standin.sql_hourly()}, r AS (
SELECT meter_id, hour, {sql_round(COLS)} FROM hourly
WHERE hour > TIMESTAMP '{ORIGIN}' - INTERVAL 168 HOUR AND hour <= TIMESTAMP '{ORIGIN}')
SELECT meter_id, hour AS ts, {", ".join(COLS)},
  CAST(row_number() OVER (PARTITION BY meter_id ORDER BY hour) AS INT) AS position FROM r""",
)
def request_nest(spark, sf_dir):
    """Nest to JSON, then read the requests back so that their content can be compared."""
    nested = requests.request_nest(
        standin.hourly(spark, sf_dir), ROLES, F.lit(ORIGIN).cast("timestamp_ntz")
    )
    parsed = nested.select(F.from_json("request", requests.request_schema(ROLES)).alias("r"))
    rows = parsed.select("r.meter_id", F.posexplode("r.history").alias("p", "e"))
    return rounded(
        rows.select(
            "meter_id",
            F.col("e.timestamp").cast("timestamp_ntz").alias("ts"),
            *[F.col(f"e.{c}").alias(c) for c in COLS],
            (F.col("p") + 1).cast("int").alias("position"),
        )
    )


@query(
    "forecast_nest",
    f"""{standin.sql_forecasts()} SELECT meter_id,
strftime(origin, '%Y-%m-%dT%H:%M:%S') AS forecast_origin_timestamp,
CAST(count(*) AS BIGINT) AS steps, CAST(min(h) AS INT) AS first_h, CAST(max(h) AS INT) AS last_h,
round(CAST(min_by(point, h) AS DOUBLE), 6) + 0.0 AS first_point,
round(CAST(max_by(lower, h) AS DOUBLE), 6) + 0.0 AS last_lower,
round(CAST(max_by(upper, h) AS DOUBLE), 6) + 0.0 AS last_upper
FROM forecasts GROUP BY meter_id, origin""",
)
def forecast_nest(spark, sf_dir):
    nested = requests.forecast_nest(forecasts.forecasts(spark, sf_dir))
    p = F.col("predictions")
    return rounded(
        nested.select(
            "meter_id",
            "forecast_origin_timestamp",
            F.size(p).cast("long").alias("steps"),
            p[0]["horizon_h"].alias("first_h"),
            p[23]["horizon_h"].alias("last_h"),
            p[0]["point_pred_kw"].alias("first_point"),
            p[23]["lower_bound_90pct_kw"].alias("last_lower"),
            p[23]["upper_bound_90pct_kw"].alias("last_upper"),
        )
    )


@query(
    "history_sufficiency",
    f"""{standin.sql_readings("user_id")}, every AS (SELECT meter_id, ts FROM readings
UNION ALL SELECT event_type, ts FROM events), n AS (
SELECT meter_id, CAST(count(DISTINCT date_trunc('hour', ts)) AS BIGINT) AS hours
FROM every GROUP BY meter_id)
SELECT meter_id, hours, CASE WHEN hours < 168 THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN hours < 168 THEN 'history has ' || hours || ' of 168 hours' END AS error FROM n""",
)
def history_sufficiency(spark, sf_dir):
    """Users have too few hours, event types have enough (from sf0.01 on)."""
    both = [standin.readings(spark, sf_dir, m).select("meter_id", F.col("ts").alias("hour")) for m in ("user_id", "event_type")]
    return scoring.history_sufficiency(both[0].unionAll(both[1]))


# -- runs --------------------------------------------------------------------
@query(
    "run_log_append",
    f"""{standin.sql_forecasts("user_id")}, days AS (
SELECT date_trunc('day', origin) AS day, *, actual - daily_naive AS e FROM forecasts),
runs AS (SELECT day, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM days GROUP BY day),
latest AS (SELECT * FROM runs WHERE day = (SELECT max(day) FROM runs))
SELECT strftime(day, '%Y%m%d') AS run_id, 'daily_naive' AS method, 'MAE' AS metric,
  round(mae, 6) AS value FROM latest
UNION ALL SELECT strftime(day, '%Y%m%d'), 'daily_naive', 'RMSE', round(rmse, 6) FROM latest""",
)
def run_log_append(spark, sf_dir):
    """One record per day of test origins, appended in two writes; then the latest, tidy."""
    path = scratch_path(spark, "runs")
    long = forecasts.forecasts(spark, sf_dir, "user_id").withColumn(
        "day", truncate_day(F.col("origin"))
    )
    y, f = F.col("actual"), F.col("daily_naive")
    daily = long.groupBy("day").agg(
        F.map_from_arrays(
            F.array(F.lit("MAE"), F.lit("RMSE")),
            F.array(metrics.mae(y, f), metrics.rmse(y, f)),
        ).alias("scores")
    )
    records = daily.select(
        F.replace(F.col("day").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("run_id"),
        F.col("day").alias("timestamp"),
        F.create_map(F.lit("learning_rate"), F.lit(0.05)).alias("hyperparameters"),
        F.lit(len(feature_columns(ROLES))).alias("num_features"),
        F.lit(0.0).alias("training_time_seconds"),
        F.create_map(F.lit("daily_naive"), F.col("scores")).alias("metrics"),
    )
    for late in (True, False):
        part = F.dayofmonth("timestamp") > 27
        runs.append_runs(records.filter(part if late else ~part), path)
    return rounded(runs.metrics_long(runs.latest_run(runs.read_runs(spark, path))))


