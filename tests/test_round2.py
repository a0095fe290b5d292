"""Ties, zones, meters without training rows, and requests that cannot be scored."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterloom.config import Roles
from meterloom.functions import calendar as cal
from meterloom.functions import scalars
from meterloom.operators import gaps, metrics, resample, scoring
from meterloom.operators.chunks import unplaced
from meterloom.sources import requests

ROLES = Roles("load", ("volt",), ("load",), ("volt",))


def tied(spark, id_type: str, null_ids: bool):
    """Pairs of rows that share (ts, row_id), several rows of one time, and gaps."""
    rows = []
    for i in range(40):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=10 * (i // 4))
        key = None if null_ids and i % 3 == 0 else i // 2
        rows.append(("a", at, str(key) if id_type == "string" and key is not None else key, None if i % 5 in (1, 2) else float(i)))
    rows += [("a", None, rows[1][2], 1.0), (None, dt.datetime(2024, 1, 1), rows[1][2], 1.0)]
    return spark.createDataFrame(rows, f"meter_id string, ts timestamp_ntz, row_id {id_type}, x double")


@pytest.mark.parametrize("id_type", ["long", "string"])
@pytest.mark.parametrize("null_ids", [False, True])
def test_ties_and_any_row_id_give_equal_rows_at_every_cut(spark, id_type, null_ids):
    df = tied(spark, id_type, null_ids)
    order = lambda rows: sorted(rows, key=str)
    for run in (
        lambda **c: gaps.gap_islands(df, "x", **c),
        lambda **c: gaps.interpolate_short_gaps(df, ["x"], 2, **c),
        lambda **c: gaps.in_time_order(df, **c),
    ):
        whole = order(run(seconds=10**9).collect())
        assert len(whole) == 40
        assert order(run().collect()) == whole
        assert order(run(seconds=600).collect()) == whole
        cut = order(run(max_rows=5).collect())
        assert len(cut) == 40
        if id_type == "long":
            assert cut == whole
    assert unplaced(df).first() == (1, 1)


ZONES = ["UTC", "Europe/Paris", "America/New_York"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    for day in ("2010-03-28", "2024-03-10"):
        rows = [("a", dt.datetime.fromisoformat(f"{day} 0{h}:15:30.250000"), h, 1.0, 2.0) for h in range(1, 5)]
        df = spark.createDataFrame(rows, "meter_id string, ts timestamp_ntz, row_id long, load double, volt double")
        found = {str(r.hour)[11:13]: r.load for r in resample.resample_sum(df, ["load"]).collect()}
        assert found == {"01": 1.0, "02": 1.0, "03": 1.0, "04": 1.0}
        one = df.select(
            cal.epoch_hour(F.col("ts")).alias("n"), cal.epoch_micros(F.col("ts")).alias("u"),
            scalars.iso_time(F.col("ts")).alias("iso"), scalars.minute_time(F.col("ts")).alias("minute"),
        ).orderBy("n").collect()
        assert [r.n - one[0].n for r in one] == [0, 1, 2, 3]
        assert one[1].iso == f"{day}T02:15:30" and one[1].minute == f"{day} 02:15"
        epoch = dt.datetime(1970, 1, 1)
        assert [r.u for r in one] == [(x[1] - epoch) // dt.timedelta(microseconds=1) for x in rows]


def test_slices_keep_a_meter_without_training_rows(spark):
    at = dt.datetime(2024, 7, 6, 5)
    rows = [("old", at, 1.0, 2.0), ("new", at, 3.0, 1.0), ("old", dt.datetime(2024, 1, 1, 5), 9.0, 1.0)]
    long = spark.createDataFrame(rows, "meter_id string, target_time timestamp_ntz, actual double, point double")
    medians = spark.createDataFrame([("old", 2.0)], "meter_id string, train_median double")
    sliced = metrics.with_slices(long, medians)
    assert {(r.meter_id, r.load_level) for r in sliced.collect()} == {
        ("old", scalars.LOW_LOAD), ("old", scalars.HIGH_LOAD), ("new", scalars.UNKNOWN_LOAD)
    }
    report = {(r.dimension, r.bucket): r.MAE for r in metrics.robustness_report(sliced).collect()}
    assert report["load_level", scalars.UNKNOWN_LOAD] == 2.0 and report["season", "Summer"] == 1.5
    assert report["season", "Winter"] == 8.0


def reading(h: int, load: float = 1.0) -> str:
    at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    return f'{{"timestamp":"{at.isoformat()}","load":{load},"volt":230.0}}'


def test_no_request_is_lost(spark):
    texts = [
        '{"meter_id":"m","history":[%s]}' % ",".join(reading(h) for h in range(3)),
        '{"meter_id":"m","history":[]}', '{"meter_id":"m"}', "garbage", '{"meter_id":"m","history":[{"timestamp":"soon","load":1.0}]}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, request string")
    rows = requests.request_explode(df, ROLES, request_id="id").collect()
    assert {r.request_id for r in rows} == {"0", "1", "2", "3", "4"} and len(rows) == 7
    assert sum(r.ts is not None for r in rows) == 3
    assert len({r.request_id for r in requests.request_explode(df, ROLES).collect()}) == 5


def test_copies_of_half_a_history_do_not_pass(spark):
    half = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for h in range(84)]
    df = spark.createDataFrame(half + half, "meter_id string, hour timestamp_ntz")
    assert scoring.history_sufficiency(df).first() == ("a", 84, "failed", "history has 84 of 168 hours")
