"""Streams, joins in time and incremental upkeep of the hourly table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators.asof import as_of_join
from meterloom.operators.intervals import interval_join
from meterloom.plans import standin
from meterloom.plans.registry import query, rounded, sql_round
from meterloom.plans.standin import COLS, MAX_GAP, ROLES, SHORT
from meterloom.session import scratch_path
from meterloom.sources.hourly_refresh import refresh_hourly, refreshed_table
from meterloom.streaming import gaps as stream_gaps

_ARRIVALS = 4


def arrivals(readings: DataFrame) -> list[DataFrame]:
    """The readings in the order of their arrival: eight days at a time, one in ten of them a batch late."""
    days = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 8)
    late = F.pmod(F.xxhash64("row_id"), F.lit(10)) == 0
    arrival = F.least(F.greatest(days, F.lit(0)) + late.cast("int"), F.lit(_ARRIVALS - 1))
    marked = readings.withColumn("arrival", arrival)
    return [marked.where(F.col("arrival") == k).drop("arrival") for k in range(_ARRIVALS)]


def _stream_once(spark: SparkSession, source: str, schema, root: str) -> None:
    """Reads what is new, file by file, from where the checkpoint left off."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    filled = stream_gaps.interpolate_stream(rows, COLS, MAX_GAP, lateness="17 days", idle="100 days")
    sink = filled.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()


def stream_files(spark: SparkSession, readings: DataFrame, root: str) -> DataFrame:
    """Readings replayed as files; the stream is stopped half-way and goes on from its checkpoint."""
    source = f"{root}/in"
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, stream_gaps.PROVIDER)
    try:
        for k, part in enumerate(arrivals(readings)):
            part.coalesce(1).write.mode("append").parquet(source)
            if k == _ARRIVALS // 2:
                _stream_once(spark, source, readings.schema, root)
        # Heartbeats of no meter carry the watermark past the end: the second lets the first one's timers run.
        beat = readings.limit(1).select(
            *[F.lit(None).cast(t).alias(c) if c != "ts" else F.lit("2025-01-01").cast(t).alias(c) for c, t in readings.dtypes]
        )
        for _ in range(2):
            beat.coalesce(1).write.mode("append").parquet(source)
        _stream_once(spark, source, readings.schema, root)
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{root}/out")


@query(
    "stream_gap_fill",
    f"{standin.sql_filled()} SELECT meter_id, ts, row_id, {sql_round(COLS)}, {', '.join(SHORT)} FROM filled",
)
def stream_gap_fill(spark, sf_dir):
    return rounded(stream_files(spark, standin.readings(spark, sf_dir), scratch_path(spark, "gap-stream")))


@query(
    "as_of_reading",
    f"""{standin.sql_readings("user_id")},
bounds AS (SELECT meter_id, date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM readings GROUP BY meter_id),
hours AS (SELECT meter_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM bounds),
valid AS (SELECT meter_id, ts, row_id, load FROM readings WHERE load IS NOT NULL)
SELECT h.meter_id, h.hour, v.row_id AS reading, {sql_round(["v.load"]).replace(" AS v.load", " AS load")}
FROM hours h ASOF LEFT JOIN valid v ON h.meter_id = v.meter_id AND h.hour >= v.ts""",
)
def as_of_reading(spark, sf_dir):
    """The last valid reading at each hour of each meter."""
    from meterloom.operators.resample import hourly_spine, meter_bounds

    readings = standin.readings(spark, sf_dir, "user_id")
    hours = hourly_spine(meter_bounds(readings))
    valid = readings.where("load IS NOT NULL")
    return rounded(as_of_join(hours, valid, ["meter_id"], "hour", "ts", {"row_id": "reading", "load": "load"}, tie=["row_id"]))


_SQL_OUTAGES = """
{c}_marked AS (
  SELECT meter_id, ts, row_id, {c} IS NULL AS out, count({c}) OVER (PARTITION BY meter_id ORDER BY ts, row_id) AS island FROM readings),
{c}_outages AS (
  SELECT meter_id, min(ts) AS start, max(ts) + INTERVAL 1 MINUTE AS stop FROM {c}_marked WHERE out GROUP BY meter_id, island)"""


@query(
    "overlapping_outages",
    f"""{standin.sql_readings()},{_SQL_OUTAGES.format(c="load")},{_SQL_OUTAGES.format(c="intensity")}
SELECT a.meter_id, a.start, a.stop, b.start AS start_right, b.stop AS stop_right
FROM load_outages a JOIN intensity_outages b ON a.meter_id = b.meter_id AND a.start < b.stop AND b.start < a.stop""",
)
def overlapping_outages(spark, sf_dir):
    """Outages of the load and of the intensity of a meter that overlap in time."""
    from meterloom.operators.gaps import gap_islands_of

    islands = gap_islands_of(standin.readings(spark, sf_dir), ["load", "intensity"])

    def outages(c: str) -> DataFrame:
        missing = islands.where(F.col(c).isNull()).groupBy("meter_id", f"island_{c}")
        stop = F.max("ts") + F.expr("INTERVAL '1' MINUTE")
        return missing.agg(F.min("ts").alias("start"), stop.alias("stop")).select("meter_id", "start", "stop")

    # No outage is shorter than a minute, so bins of a minute keep apart what doesn't overlap on crowded days.
    spans = ("start", "stop"), ("start", "stop")
    pairs = interval_join(outages("load"), outages("intensity"), ["meter_id"], *spans, bin_seconds=60)
    return pairs.drop("meter_id_right")


@query(
    "hourly_incremental",
    f"{standin.sql_raw_hourly()} SELECT meter_id, hour, {sql_round(COLS)}, {', '.join(SHORT)} FROM raw_hourly",
)
def hourly_incremental(spark, sf_dir):
    """The raw hourly table after four batches with late readings, one of them applied twice."""
    root = scratch_path(spark, "hourly-upkeep")
    for k, part in enumerate(arrivals(standin.readings(spark, sf_dir))):
        for _ in range(1 + (k == 1)):
            refresh_hourly(part, root, f"b{k}", ROLES, max_gap=MAX_GAP, unit="day")
    return rounded(refreshed_table(spark, root))
