"""Streams, joins in time and incremental upkeep, against brute force."""

import datetime as dt
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.config import Roles
from meterloom.operators import gaps, resample
from meterloom.operators.asof import as_of_join
from meterloom.operators.intervals import interval_join, with_points
from meterloom.sources.hourly_refresh import refresh_hourly, refreshed_table
from meterloom.streaming import gaps as stream_gaps

T0 = dt.datetime(2024, 1, 1)
ROLES = Roles(target="load", exog=("volt",), sum_cols=("load",), mean_cols=("volt",))
READING = "meter_id string, ts timestamp_ntz, row_id long, load double, volt double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def made_readings(seed, n=400, meters=3, span=20 * 86_400):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        missing = draw.random() < 0.5
        ts = at(draw.randrange(span)) if draw.random() < 0.9 else at(3_600 * draw.randrange(span // 3_600))
        rows.append((f"m{draw.randrange(meters)}", ts, i, None if missing else float(draw.randrange(100)), None if draw.random() < 0.3 else 1.5 * i))
    return rows


# -- as-of join ---------------------------------------------------------------
def brute_as_of(left, right, strict=False, tolerance=None, how="left"):
    out = []
    for key, time, name in left:
        found = None
        if key is not None and time is not None:
            for k, t, tie, v in right:
                if k == key and t is not None and (t < time or t == time and not strict):
                    if found is None or (t, tie) > found[:2]:
                        found = (t, tie, v)
            if found and tolerance is not None and (time - found[0]).total_seconds() > tolerance:
                found = None
        if found or how == "left":
            out.append((name, found[2] if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"strict": True}, {"tolerance_seconds": 7_000}, {"how": "inner"}])
def test_as_of_join_equals_brute_force(spark, options):
    draw = random.Random(1)
    time = lambda: None if draw.random() < 0.05 else at(3_600 * draw.randrange(60) + draw.choice([0, 0, 1]))
    key = lambda: None if draw.random() < 0.05 else draw.choice("abc")
    left = [(key(), time(), i) for i in range(150)]
    right = [(key(), time(), i, None if i % 5 == 0 else f"v{i}") for i in range(80)]
    a = spark.createDataFrame(left, "k string, t timestamp_ntz, name int")
    b = spark.createDataFrame(right, "k string, t timestamp_ntz, tie int, v string")
    joined = as_of_join(a, b, ["k"], "t", "t", {"v": "value"}, tie=["tie"], bucket_seconds=20_000, **options)
    assert joined.columns == ["k", "t", "name", "value"]
    got = sorted(((r.name, r.value) for r in joined.collect()), key=str)
    want = brute_as_of(left, right, options.get("strict", False), options.get("tolerance_seconds"), options.get("how", "left"))
    assert got == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_as_of_join_edges(spark):
    a = spark.createDataFrame([("x", at(10), 1)], "k string, t timestamp_ntz, v int")
    assert as_of_join(a, a.limit(0), ["k"], "t", "t", {"v": "found"}).collect()[0].found is None
    assert as_of_join(a.limit(0), a, ["k"], "t", "t", {"v": "found"}).count() == 0
    twice = as_of_join(a.union(a), a, ["k"], "t", "t", {"v": "found"})
    assert [r.found for r in twice.collect()] == [1, 1]
    with pytest.raises(ValueError):
        as_of_join(a, a, ["k"], "t", "t", {"v": "v"})


# -- interval join ------------------------------------------------------------
def spans(draw, n, lengths):
    rows = []
    for i in range(n):
        start = draw.randrange(200_000)
        rows.append((draw.choice(["a", "b", None]), None if draw.random() < 0.03 else at(start), at(start + draw.choice(lengths)), i))
    return rows


def brute_overlaps(left, right):
    return sorted(
        (i, j) for k, s, e, i in left for q, u, v, j in right
        if k is not None and k == q and s and u and s < e and u < v and s < v and u < e
    )


@pytest.mark.parametrize("lengths", [[0, 1, 10, 500], [30, 3_000, 90_000], [5, 10**9]])
def test_interval_join_equals_theta_join(spark, lengths):
    draw = random.Random(2)
    left, right = spans(draw, 120, lengths), spans(draw, 120, [*lengths, -5])
    schema = "k string, s timestamp_ntz, e timestamp_ntz, i int"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    joined = interval_join(a, b, ["k"], ("s", "e"), ("s", "e"), bin_seconds=100, factor=4)
    assert joined.columns == ["k", "s", "e", "i", "k_right", "s_right", "e_right", "i_right"]
    assert sorted((r.i, r.i_right) for r in joined.collect()) == brute_overlaps(left, right)


def test_points_and_touching_intervals(spark):
    schema = "k string, s timestamp_ntz, e timestamp_ntz"
    a = spark.createDataFrame([("x", at(0), at(10)), ("x", at(10), at(20))], schema)
    points = with_points(spark.createDataFrame([("x", at(t), t) for t in (0, 5, 10, 20)], "k string, p timestamp_ntz, n int"), "p")
    found = interval_join(a, points, ["k"], ("s", "e"), ("p", "end"))
    assert sorted((r.s, r.n) for r in found.collect()) == [(at(0), 0), (at(0), 5), (at(10), 10)]
    both = interval_join(a, a, ["k"], ("s", "e"), ("s", "e"))
    assert both.count() == 2


def test_one_long_interval_costs_few_rows(spark):
    """An interval of thirty years beside ten thousand short ones: rows to join grow with the intervals."""
    from meterloom.operators import intervals

    long = spark.createDataFrame([("x", at(-10**9), at(10**6))], "k string, s timestamp_ntz, e timestamp_ntz")
    short = spark.range(10_000).select(
        F.lit("x").alias("k"), (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id") * 7)).alias("s")
    ).withColumn("e", F.col("s") + F.expr("INTERVAL 5 SECONDS"))
    rows = intervals._binned(long, ["k"], "s", "e", "a", 3600, 8)
    assert rows.count() <= 9 * intervals.LEVELS
    assert intervals._binned(short, ["k"], "s", "e", "b", 3600, 8).count() <= 2 * intervals.LEVELS * 10_000
    assert interval_join(long, short, ["k"], ("s", "e"), ("s", "e")).count() == 10_000


def test_crowds_of_short_intervals_do_not_meet_in_wide_bins(spark):
    """Twenty thousand short intervals of one key on either side: rows that share a join key grow with them."""
    from meterloom.operators import intervals

    n = 20_000
    short = spark.range(n).select(
        F.lit("x").alias("k"), (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id") * 60)).alias("s")
    ).withColumn("e", F.col("s") + F.expr("INTERVAL 50 SECONDS"))
    a, b = (intervals._binned(short, ["k"], "s", "e", side, 60, 8) for side in "ab")
    keys = [c for c in a.columns if c in b.columns]
    counts = [x.groupBy(*keys).agg(F.count("*").alias(c)) for x, c in ((a, "n"), (b, "m"))]
    assert counts[0].join(counts[1], keys).agg(F.sum(F.col("n") * F.col("m"))).first()[0] <= 10 * n
    assert interval_join(short, short, ["k"], ("s", "e"), ("s", "e"), bin_seconds=60).count() == n


# -- incremental upkeep -------------------------------------------------------
def rebuilt(readings):
    filled = gaps.interpolate_short_gaps(readings, ROLES.all_cols, 2)
    return resample.resample_hourly(filled, ROLES, bounds=resample.meter_bounds(readings))


def same(got, want):
    rows = lambda t: sorted(tuple(r[c] for c in want.columns) for r in t.collect())
    a, b = rows(got), rows(want)
    assert [r[:2] for r in a] == [r[:2] for r in b]
    for x, y in zip(a, b, strict=True):
        assert x[2:] == pytest.approx(y[2:], abs=1e-9) if None not in x[2:] + y[2:] else x[2:] == y[2:]


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root, "hourly").rglob("*.parquet")}


@pytest.mark.parametrize("unit", ["day", "month"])
def test_batches_equal_a_full_rebuild(spark, tmp_path, unit):
    rows = made_readings(3, span=60 * 86_400 if unit == "month" else 20 * 86_400)
    draw = random.Random(7)
    batches = [[], [], []]
    for r in sorted(rows, key=lambda r: r[1]):
        k = min(2, int((r[1] - T0).days * 3 / (60 if unit == "month" else 20)))
        batches[min(2, k + (draw.random() < 0.2))].append(r)
    batches[1].append((None, at(5), 99_999, 1.0, 1.0))
    root = str(tmp_path / "root")
    for k, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, READING)
        assert refresh_hourly(frame, root, f"b{k}", ROLES, max_gap=2, unit=unit)
        so_far = spark.createDataFrame([r for b in batches[: k + 1] for r in b if r[0]], READING)
        same(refreshed_table(spark, root), rebuilt(so_far))
    before = files(root)
    assert not refresh_hourly(spark.createDataFrame(batches[1], READING), root, "b1", ROLES, max_gap=2, unit=unit)
    assert files(root) == before


def test_untouched_periods_keep_their_files_and_a_retry_is_safe(spark, tmp_path):
    root = str(tmp_path / "root")
    rows = made_readings(4, n=600)
    assert refresh_hourly(spark.createDataFrame(rows, READING), root, "a", ROLES, max_gap=2, unit="day")
    before = files(root)
    late = [("m1", at(5 * 86_400 + 60), 10_000, 7.0, None), ("m1", at(5 * 86_400 + 90), 10_001, None, None)]
    frame = spark.createDataFrame(late, READING)
    # A try that died before the log was written left its readings.
    frame.withColumn("period", F.lit("2024-01-06")).withColumn("batch", F.lit("b")).write.partitionBy("period", "batch").mode("append").parquet(f"{root}/readings")
    assert refresh_hourly(frame, root, "b", ROLES, max_gap=2, unit="day")
    same(refreshed_table(spark, root), rebuilt(spark.createDataFrame(rows + late, READING)))
    after = files(root)
    kept = {p for p, t in before.items() if after.get(p) == t}
    days = {p.parent.name for p in before}
    assert {p.parent.name for p in before if p not in kept} <= {f"period=2024-01-{d:02d}" for d in (5, 6, 7)}
    assert len({p.parent.name for p in kept}) >= len(days) - 3


# -- stream -------------------------------------------------------------------
def test_series_state_equals_batch_rules():
    """All patterns of ten readings in one column, and two columns together."""
    for bits in range(1 << 10):
        values = [float(i) if bits >> i & 1 else None for i in range(10)]
        for max_gap in (0, 1, 3):
            state, out = stream_gaps.GapState(2, max_gap), []
            for i, v in enumerate(values):
                out += state.add(i, i, [v, values[9 - i]])
                assert len(state.held) <= max_gap
            out += state.finish()
            assert [r[1] for r in out] == list(range(10))
            for c, column in enumerate((values, values[::-1])):
                assert [(r[2][c], r[3][c]) for r in out] == brute_fill(column, max_gap)


def brute_fill(values, max_gap):
    known = [i for i, v in enumerate(values) if v is not None]
    out = []
    for i, v in enumerate(values):
        if v is not None:
            out.append((v, 0))
            continue
        p, n = max((k for k in known if k < i), default=-1), min((k for k in known if k > i), default=len(values))
        if n - p - 1 > max_gap:
            out.append((None, 0))
        elif p < 0:
            out.append((None, 1))
        else:
            out.append((values[p] if n == len(values) else values[p] + (values[n] - values[p]) * (i - p) / (n - p), 1))
    return out


def test_stream_equals_batch_across_a_restart_and_drops_what_is_too_late(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    rows = sorted(made_readings(5, n=200, meters=2), key=lambda r: r[1])
    source, beat = str(tmp_path / "in"), (None, at(10**9), None, None, None)
    late = ("m0", at(1), 5_000, 1.0, 1.0)
    steps = [rows[:70], rows[75:140], rows[70:75] + rows[140:], [late, beat], [beat]]
    with pytest.raises(ValueError):
        stream_gaps.interpolate_stream(spark.createDataFrame(rows, READING), ["load", "volt"])
    spark.conf.set(provider, stream_gaps.PROVIDER)
    try:
        for k, step in enumerate(steps):
            spark.createDataFrame(step, READING).coalesce(1).write.mode("append").parquet(source)
            if k in (1, 4):
                stream = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(source)
                filled = stream_gaps.interpolate_stream(stream, ["load", "volt"], 2, lateness="9 days", idle="100 days")
                sink = filled.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = gaps.interpolate_short_gaps(spark.createDataFrame(rows, READING), ["load", "volt"], 2).select(got.columns)
    assert got.count() == 200 and got.exceptAll(want).count() == 0


def test_waiting_readings_of_a_stream_are_merged_a_page_at_a_time():
    rng, columns = np.random.default_rng(6), 2
    pages, held, most, want = {}, set(), [0], []

    def load(number, page):
        held.add(number)
        most[0] = max(most[0], len(held))
        return pages[number, page]

    def drop(number, page):
        del pages[number, page]
        held.discard(number)

    runs = []
    for number in range(40):  # a hundred times each, so the two runs beside each other overlap
        rows = np.zeros(250, stream_gaps._reading(columns))
        rows["micros"] = rng.integers(100 * (number // 2), 100 * (number // 2) + 100, 250)
        rows["has_id"], rows["row_id"] = True, rng.integers(0, 3, 250)
        rows["has"][:, 0] = rng.random(250) < 0.5
        rows["values"][:, 0] = np.where(rows["has"][:, 0], rng.normal(size=250), 0)
        rows = stream_gaps._in_order(rows)
        want += zip(*(k.tolist() for k in stream_gaps._sort_keys(rows)), strict=True)
        pages |= {(number, page): rows[page * 100 : page * 100 + 100] for page in range(3)}
        runs.append(stream_gaps.Run(number, 0, 3, 0, int(rows["micros"][0])))
    want.sort()
    early = list(stream_gaps.merged(runs, 1050, load, drop))
    kept = [stream_gaps.Run(*r.place()) for r in runs if r.page < r.pages]  # as state gives them back
    held.clear()
    assert early == [w for w in want if w[0] < 1050] and all(r.first >= 1050 for r in kept)
    assert early + list(stream_gaps.merged(kept, 10**9, load, drop)) == want
    assert not pages and most[0] <= 4
