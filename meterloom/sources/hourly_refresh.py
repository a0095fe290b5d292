"""The raw hourly table (gaps filled, not yet completed from the profile), kept up batch by batch.

Below one root: ``readings`` (partitioned by period and batch), ``hourly`` (partitioned by period) and ``log`` (one
folder a batch: the count, first and last reading of each of its meters and periods). A refresh

1. writes the batch's readings, overwriting what an earlier try of the same batch left;
2. finds what changes: the (meter, period) of the batch; the periods of the ``max_gap + 1`` readings just before and
   after these, whose gaps may reach across the border; and the periods that the meter's span grew by, where hours
   without readings appear;
3. recomputes those from their readings and a halo of ``max_gap + 1`` readings on either side, which decides every
   gap of up to ``max_gap`` as the whole series would;
4. rewrites the touched periods by dynamic partition overwrite, other meters' hours copied; other periods keep their
   files;
5. logs the batch. A batch in the log is not applied again, and a refresh that died before may be repeated.

One refresh at a time may run on a root. Readings must have meter_id, ts, row_id and the columns of the roles; those without a meter or a time are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.config import MAX_GAP, Roles
from meterloom.functions.calendar import truncate_hour
from meterloom.operators import gaps, resample

#: How periods are named: the head of the time as text.
UNITS = {"month": 7, "day": 10}


def _has(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def _period(time: Column, unit: str) -> Column:
    return F.substring(time.cast("timestamp_ntz").cast("string"), 1, UNITS[unit])


def _ddl(rows: DataFrame, *more: str) -> str:
    return ", ".join([f"`{c}` {t}" for c, t in rows.dtypes] + [f"{c} string" for c in more])


def _overwrite(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _around(counts: DataFrame, some: DataFrame, reach: int) -> DataFrame:
    """meter_id, period: ``some`` and those that hold the ``reach`` readings before and after them, by counts alone."""
    marks = counts.join(some.withColumn("hit", F.lit(True)), ["meter_id", "period"], "full")
    marks = marks.select("meter_id", "period", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hit", F.lit(False)).alias("hit"))
    for name, order in (("after", F.asc("period")), ("before", F.desc("period"))):
        upto = Window.partitionBy("meter_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        marks = marks.withColumn("total", F.sum("n").over(upto))
        # Readings that lie between the last such period and this one.
        at_hit = F.last(F.when(F.col("hit"), F.col("total")), ignorenulls=True).over(upto)
        marks = marks.withColumn(name, F.col("total") - at_hit - F.col("n"))
    close = F.col("hit") | (F.col("after") < reach) | (F.col("before") < reach)
    return marks.where(close).select("meter_id", "period")


def refresh_hourly(
    batch: DataFrame, root: str, batch_id: str, roles: Roles, *, max_gap: int = MAX_GAP, unit: str = "month"
) -> bool:
    """Brings ``batch`` into the table below ``root``; False if that batch is in it already."""
    spark = batch.sparkSession
    if _has(spark, f"{root}/log/batch={batch_id}/_SUCCESS"):
        return False
    plain = batch.where("meter_id IS NOT NULL AND ts IS NOT NULL").select("meter_id", "ts", "row_id", *roles.all_cols)
    placed = plain.withColumn("period", _period(F.col("ts"), unit)).withColumn("batch", F.lit(batch_id))
    _overwrite(placed, f"{root}/readings", "period", "batch")
    readings = spark.read.schema(_ddl(plain, "period", "batch")).parquet(f"{root}/readings")
    own = readings.where(F.col("batch") == batch_id).groupBy("meter_id", "period")
    own = own.agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    work = f"{root}/work/{batch_id}"
    own = _kept(own, f"{work}/own")

    span = [F.min("first").alias("first"), F.max("last").alias("last")]
    bounds = own.groupBy("meter_id").agg(*span)
    counts = own.select("meter_id", "period", "n")
    if _has(spark, f"{root}/log"):
        log = spark.read.schema(_ddl(own, "batch")).parquet(f"{root}/log")
        log = log.join(bounds.select("meter_id"), "meter_id", "left_semi")
        counts = counts.unionByName(log.select("meter_id", "period", "n")).groupBy("meter_id", "period").agg(F.sum("n").alias("n"))
        old = log.groupBy("meter_id").agg(F.min("first").alias("old_first"), F.max("last").alias("old_last"))
    else:
        old = bounds.select("meter_id", F.col("first").alias("old_first"), F.col("last").alias("old_last")).limit(0)
    spans = bounds.join(old, "meter_id", "left").select(
        "meter_id", "old_first", "old_last", F.least("first", "old_first").alias("first"), F.greatest("last", "old_last").alias("last")
    )
    spans, counts = _kept(spans, f"{work}/spans"), _kept(counts, f"{work}/counts")

    # Hours that the meter's span grew by, on either side of the old one.
    new = F.array(F.struct("first", F.coalesce("old_first", "last").alias("to")), F.struct(F.coalesce("old_last", "last").alias("first"), F.col("last").alias("to")))
    grown = spans.select("meter_id", F.explode(new).alias("s")).where("s.first < s.to")
    step = F.sequence(F.trunc("s.first", unit) if unit == "month" else F.to_date("s.first"), F.to_date("s.to"), F.expr(f"INTERVAL 1 {unit}"))
    grown = grown.select("meter_id", F.explode(step).alias("d")).select("meter_id", _period(F.col("d"), unit).alias("period"))
    touched = _around(counts, own.select("meter_id", "period"), max_gap + 1).union(grown).distinct()
    touched = _kept(touched, f"{work}/touched")
    wide = _kept(_around(counts, touched, max_gap + 1), f"{work}/wide")

    # Periods are named to the scans, so that no other files are opened; there are as many as the calendar has.
    named = lambda rows: F.col("period").isin([r.period for r in rows.select("period").distinct().collect()])
    some = readings.where(named(wide)).join(wide, ["meter_id", "period"], "left_semi").select(*plain.columns)
    filled = gaps.interpolate_short_gaps(some, roles.all_cols, max_gap)
    hours = spans.select("meter_id", truncate_hour(F.col("first")).alias("first_hour"), truncate_hour(F.col("last")).alias("last_hour"))
    fresh = resample.resample_hourly(filled, roles, bounds=hours)
    table = _ddl(fresh, "period")
    fresh = fresh.withColumn("period", _period(F.col("hour"), unit)).join(touched, ["meter_id", "period"], "left_semi")
    fresh = fresh.select(*[c for c in fresh.columns if c != "period"], "period")
    if _has(spark, f"{root}/hourly"):
        before = spark.read.schema(table).parquet(f"{root}/hourly").where(named(touched))
        fresh = fresh.unionByName(before.join(touched, ["meter_id", "period"], "left_anti"))
    ordered = fresh.hint("rebalance", "period").sortWithinPartitions("period", "meter_id", "hour")
    _overwrite(ordered, f"{root}/hourly", "period")
    own.write.mode("overwrite").parquet(f"{root}/log/batch={batch_id}")
    return True


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def refreshed_table(spark: SparkSession, root: str) -> DataFrame:
    """The raw hourly table below ``root``."""
    return spark.read.parquet(f"{root}/hourly").drop("period")
