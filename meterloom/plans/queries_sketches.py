"""Mergeable states, ranks over a global order, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.operators import sketches
from meterloom.operators.ranks import with_ranks
from meterloom.operators.sessions import reading_sessions
from meterloom.plans import standin
from meterloom.plans.registry import query, rounded
from meterloom.session import scratch_path

_LEVELS = (0.05, 0.5, 0.95)
_K = 400


def _daily_states(spark, sf_dir):
    """A stored table of the load's quantile states by meter and day."""
    rows = standin.readings(spark, sf_dir, "user_id").withColumn("day", F.col("ts").cast("date"))
    path = scratch_path(spark, "quantile-states")
    sketches.quantile_states(rows, ["meter_id", "day"], ["load"], _K).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "quantile_weeks",
    f"""{standin.sql_readings("user_id")}, levels AS (SELECT unnest([0.05, 0.5, 0.95]) AS level)
SELECT meter_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, level, count(load) AS n,
  round(list_sort(list(load))[CAST(ceil(level * count(load) - 1e-9) AS BIGINT)], 6) + 0.0 AS value
FROM readings, levels WHERE load IS NOT NULL
GROUP BY meter_id, CAST(date_trunc('week', ts) AS DATE), level""",
)
def quantile_weeks(spark, sf_dir):
    """Quantiles of each meter's weeks, merged from its days; so few readings a week that they are exact."""
    states = _daily_states(spark, sf_dir).withColumn("week", F.date_trunc("week", F.col("day").cast("timestamp_ntz")).cast("date").cast("string"))
    merged = sketches.merged_states(states, ["meter_id", "week"], ["load"], _K)
    return rounded(sketches.quantiles_of(merged, "load", _LEVELS))


@query(
    "quantile_bounds",
    f"""{standin.sql_readings("user_id")}, levels AS (SELECT unnest([0.05, 0.5, 0.95]) AS level)
SELECT level, count(load) AS n, TRUE AS within_bound FROM readings, levels GROUP BY level""",
)
def quantile_bounds(spark, sf_dir):
    """Quantiles over all meters and days, merged from the same states: the true rank of each is within the bound."""
    merged = sketches.merged_states(_daily_states(spark, sf_dir), [], ["load"], _K)
    found = sketches.quantiles_of(merged, "load", _LEVELS)
    answers = found.collect()  # one a level
    load = F.col("load")
    counts = [
        F.struct(
            F.lit(r.level).alias("level"), F.lit(r.n).alias("n"), F.count_if(load < r.value).alias("below"), F.count_if(load <= r.value).alias("upto")
        )
        for r in answers
    ]
    counted = standin.readings(spark, sf_dir, "user_id").agg(F.array(*counts).alias("c")).select(F.inline("c"))
    error = F.lit(sketches.rank_error(_K)) * F.col("n")
    at = F.col("level") * F.col("n")
    within = (F.col("below") - error <= at) & (at <= F.col("upto") + error)
    return counted.select("level", "n", within.alias("within_bound"))


_DIMENSIONS = ("event_type", "weekday", "part_of_day")


@query(
    "distinct_cube",
    """WITH e AS (SELECT event_type, CAST(isodow(ts) AS INT) AS weekday, CAST(hour(ts) // 6 AS INT) AS part_of_day, user_id FROM events)
SELECT event_type, weekday, part_of_day, GROUPING(event_type, weekday, part_of_day) AS grouping_id,
  count(DISTINCT user_id) AS items FROM e GROUP BY CUBE (event_type, weekday, part_of_day)""",
)
def distinct_cube(spark, sf_dir):
    """Distinct users of every grouping set, from one pass over the events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(
        "event_type", (F.weekday("ts") + 1).cast("int").alias("weekday"), F.floor(F.hour("ts") / 6).cast("int").alias("part_of_day"), "user_id"
    )
    return sketches.distinct_cube(sketches.distinct_states(rows, _DIMENSIONS, "user_id"), _DIMENSIONS)


@query(
    "global_ranks",
    """SELECT event_id, rank() OVER v AS rank, dense_rank() OVER v AS dense_rank, round(percent_rank() OVER v, 9) AS percent_rank,
  round(cume_dist() OVER v, 9) AS cume_dist, CAST(ntile(97) OVER (ORDER BY value, event_id) AS INT) AS ntile
FROM events WINDOW v AS (ORDER BY value)""",
)
def global_ranks(spark, sf_dir):
    """Ranks of all events by value, and their 97 tiles by value and id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    ranked = with_ranks(events, ["value"])
    tiled = with_ranks(events, ["value", "event_id"], tiles=97).select("event_id", "ntile")
    return rounded(ranked.join(tiled, "event_id").drop("value"), 9)


@query(
    "reading_sessions",
    """WITH r AS (SELECT user_id, ts, (4 + user_id % 3) * 3600 AS gap FROM events),
m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= to_seconds(gap) THEN 0 ELSE 1 END AS opens FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM m)
SELECT CAST(user_id AS VARCHAR) AS meter_id, min(ts) AS start, max(ts) + to_seconds(any_value(gap)) AS stop, count(*) AS readings
FROM s GROUP BY user_id, session""",
)
def sessions_of_readings(spark, sf_dir):
    """Sessions of each meter's readings, with a gap of four to six hours by meter."""
    rows = standin.readings(spark, sf_dir, "user_id").select("meter_id", "ts")
    return reading_sessions(rows.withColumn("gap", (4 + F.col("meter_id").cast("long") % 3) * 3600), "gap")
