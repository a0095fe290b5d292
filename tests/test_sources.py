import pandas as pd
from pyspark.sql import functions as F

from meterloom.config import HOUSEHOLD, Roles
from meterloom.operators import scoring
from meterloom.session import scratch_path
from meterloom.sources import hourly_table, readings, requests, runs
from meterloom.streaming.hourly import hourly_stream

HEADER = ";".join(["Date", "Time", *HOUSEHOLD.all_cols])


def write(tmp_path, lines):
    (tmp_path / "meter.txt").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path / "meter.txt")


def test_read_readings(spark, tmp_path):
    path = write(
        tmp_path,
        [
            "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000",
            "1/1/2007;00:00:00;?;;nan; 1.5 ;x;0;0",
            "31/02/2007;00:00:00;1;1;1;1;1;1;1",
            "xx;00:00:00;1;1;1;1;1;1;1",
        ],
    )
    rows = readings.read_readings(spark, path, HOUSEHOLD, meter_id="home").orderBy("ts").collect()
    assert [str(r.ts) for r in rows] == ["2006-12-16 17:24:00", "2007-01-01 00:00:00"]
    assert rows[0].meter_id == "home" and abs(rows[0].Global_active_power - 4.216) < 1e-6
    second = rows[1]
    assert second.Global_active_power is None and second.Global_reactive_power is None
    assert second.Voltage is None and second.Global_intensity == 1.5 and second.Sub_metering_1 is None


def test_hourly_table_is_built_once(spark):
    path, built = scratch_path(spark, "cache"), []
    table = spark.sql(
        "select 'a' meter_id, explode(sequence(timestamp_ntz'2024-01-30', timestamp_ntz'2024-02-02',"
        " interval 1 hour)) hour, 1.0D x"
    )

    def build():
        built.append(1)
        return table

    first = hourly_table.hourly_table(spark, path, build)
    again = hourly_table.hourly_table(spark, path, build)
    assert len(built) == 1 and first.count() == again.count() == 73
    assert set(again.columns) == {"meter_id", "hour", "x"}


ROLES = Roles("load", ("volt",), ("load",), ("volt",))


def test_requests_round_trip(spark):
    hours = pd.date_range("2024-01-01", periods=200, freq="h")
    rows = [("a", h.to_pydatetime(), float(i), 230.0) for i, h in enumerate(hours)]
    hourly = spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz, load double, volt double")
    origin = F.lit("2024-01-08 12:00:00").cast("timestamp_ntz")
    nested = requests.request_nest(hourly, ROLES, origin)
    back = requests.request_explode(nested, ROLES).orderBy("ts").collect()
    assert len(back) == 168
    assert str(back[-1].ts) == "2024-01-08 12:00:00" and back[-1].load == 180.0


def test_short_history_fails_without_an_exception(spark):
    rows = [("a", h.to_pydatetime()) for h in pd.date_range("2024-01-01", periods=167, freq="h")]
    rows += [("b", h.to_pydatetime()) for h in pd.date_range("2024-01-01", periods=168, freq="h")]
    df = spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz")
    status = {r.meter_id: r.status for r in scoring.history_sufficiency(df).collect()}
    assert status == {"a": "failed", "b": "ok"}


def test_run_log(spark):
    path = scratch_path(spark, "runs")
    for run, day, metrics in [
        ("r1", "2024-01-01", {"model": {"MAE": 2.0}}),
        ("r2", "2024-01-02", {"model": {"MAE": 1.0, "R2": 0.4}, "daily": {"MAE": 3.0}}),
    ]:
        record = (run, pd.Timestamp(day).to_pydatetime(), {"depth": 6.0}, 61, 1.5, metrics)
        runs.append_runs(spark.createDataFrame([record], runs.RUN_SCHEMA), path)
    log = runs.read_runs(spark, path)
    latest = runs.latest_run(log)
    assert log.count() == 2 and latest.first().run_id == "r2"
    tidy = {(r.method, r.metric): r.value for r in runs.metrics_long(latest).collect()}
    assert tidy == {("model", "MAE"): 1.0, ("model", "R2"): 0.4, ("daily", "MAE"): 3.0}


def test_hourly_stream_equals_batch(spark, tmp_path):
    rows = [
        ("a", pd.Timestamp("2024-01-01 00:10").to_pydatetime(), 1.0, 230.0),
        ("a", pd.Timestamp("2024-01-01 00:50").to_pydatetime(), 2.0, 232.0),
        ("a", pd.Timestamp("2024-01-01 02:00").to_pydatetime(), 4.0, None),
        ("b", pd.Timestamp("2024-01-01 00:30").to_pydatetime(), None, 228.0),
        ("z", pd.Timestamp("2024-01-02 00:00").to_pydatetime(), 0.0, 0.0),
    ]
    schema = "meter_id string, ts timestamp_ntz, load double, volt double"
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    stream = hourly_stream(spark.readStream.schema(schema).parquet(source), ROLES)
    query = (
        stream.writeStream.format("memory")
        .queryName("hourly_out")
        .outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = {(r.meter_id, str(r.hour)[11:13]): (r.load, r.volt) for r in spark.table("hourly_out").collect()}
    assert got == {
        ("a", "00"): (3.0, 231.0),
        ("a", "02"): (4.0, None),
        ("b", "00"): (0.0, 228.0),
    }


def test_a_range_of_hours_opens_its_months_only(spark):
    hours = pd.date_range("2024-01-30", "2024-04-02", freq="6h")
    rows = [(m, h.to_pydatetime(), float(i)) for m in "ab" for i, h in enumerate(hours)]
    path = scratch_path(spark, "months")
    hourly_table.write_hourly(spark.createDataFrame(rows, "meter_id string, hour timestamp_ntz, load double"), path)
    first, last = "2024-02-28 06:00:00", "2024-03-31 12:00:00"
    found = hourly_table.hourly_between(spark, path, first, last)
    wanted = [r for r in rows if pd.Timestamp(first) <= r[1] <= pd.Timestamp(last)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "month" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert hourly_table.hourly_between(spark, path).count() == len(rows)
