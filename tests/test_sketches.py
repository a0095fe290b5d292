"""Mergeable states, ranks and sessions against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterloom.operators import sketches
from meterloom.operators.ranks import with_ranks
from meterloom.operators.sessions import reading_sessions

T0 = dt.datetime(2024, 1, 1)


def test_quantiles_of_merged_states_keep_the_bound(spark):
    """Sixty days of unequal size and order, merged by twos and all at once."""
    draw = random.Random(1)
    rows = [(d, draw.gauss(d % 7, 3) if draw.random() < 0.9 else 5.0) for d in range(60) for _ in range(50 + 40 * (d % 5))]
    days = spark.createDataFrame(rows, "day int, x double")
    states = sketches.quantile_states(days, ["day"], ["x"], 200)
    twos = sketches.merged_states(states.withColumn("two", F.col("day") % 2), ["two"], ["x"], 200)
    values = sorted(x for _, x in rows)
    for merged in (sketches.merged_states(states, [], ["x"], 200), sketches.merged_states(twos, [], ["x"], 200)):
        for r in sketches.quantiles_of(merged, "x", [0.01, 0.25, 0.5, 0.75, 0.99]).collect():
            assert r.n == len(values)
            below, upto = sum(v < r.value for v in values) / r.n, sum(v <= r.value for v in values) / r.n
            assert below - sketches.rank_error(200) <= r.level <= upto + sketches.rank_error(200)


def test_small_states_are_exact_and_nulls_have_no_part(spark):
    rows = spark.createDataFrame([("a", float(i)) for i in range(100)] + [("a", None), ("b", None)], "m string, x double")
    states = sketches.quantile_states(rows, ["m"], ["x"], 400)
    found = {r.level: (r.n, r.value) for r in sketches.quantiles_of(states, "x", [0.01, 0.5, 1.0]).collect()}
    assert found == {0.01: (100, 0.0), 0.5: (100, 49.0), 1.0: (100, 99.0)}
    assert sketches.quantiles_of(states.limit(0), "x", [0.5]).count() == 0


def test_distinct_counts_of_every_grouping_set(spark):
    draw = random.Random(2)
    rows = [(draw.choice("abc"), draw.randrange(4), draw.randrange(30_000)) for _ in range(40_000)]
    frame = spark.createDataFrame(rows, "p string, q int, u int")
    exact = {}
    for p, q, u in rows:
        for key in ((p, q), (p, None), (None, q), (None, None)):
            exact.setdefault(key, set()).add(u)
    for lg, error in ((14, 0.05), (9, 0.25)):
        states = sketches.distinct_states(frame, ["p", "q"], "u", lg)
        got = {(r.p, r.q): r["items"] for r in sketches.distinct_cube(states, ["p", "q"], lg).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[k] / len(exact[k]) - 1) < error for k in got)
        if lg == 14:
            assert all(got[k] == len(exact[k]) for k in got if len(exact[k]) < 2**13)
    plan = sketches.distinct_cube(sketches.distinct_states(frame, ["p", "q"], "u"), ["p", "q"])._jdf.queryExecution().executedPlan().toString()
    # Cells are expanded, above the first aggregate, and not rows.
    assert plan.index("Expand") < plan.rindex("ObjectHashAggregate")


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_ranks_equal_a_global_window(spark, n):
    draw = random.Random(n)
    rows = [(i, None if draw.random() < 0.1 else draw.choice([1.5, 1.5, float(draw.randrange(40))])) for i in range(n)]
    frame = spark.createDataFrame(rows, "i int, v double")
    from pyspark.sql import Window

    over, unique = Window.orderBy("v"), Window.orderBy("v", "i")
    want = frame.select(
        "i", "v", F.rank().over(over).alias("rank"), F.dense_rank().over(over).alias("dense_rank"),
        F.percent_rank().over(over).alias("percent_rank"), F.cume_dist().over(over).alias("cume_dist"),
    )
    got = with_ranks(frame, ["v"])
    assert got.columns == want.columns
    key = lambda r: tuple(round(x, 12) if isinstance(x, float) else x for x in r[2:]) + (r.i,)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    for tiles in (1, 3, 97):
        tiled = {r.i: r.ntile for r in with_ranks(frame, ["v", "i"], tiles=tiles).collect()}
        assert tiled == {r.i: r.t for r in frame.select("i", F.ntile(tiles).over(unique).alias("t")).collect()}


def test_ranks_need_no_window_over_all_rows(spark):
    frame = spark.range(1000).withColumn("v", F.col("id") % 50)
    plan = with_ranks(frame, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan and "Cartesian" not in plan


def brute_sessions(rows, gap):
    out = []
    for meter in sorted({m for m, _ in rows}):
        own = sorted(t for m, t in rows if m == meter)
        at = [own[0], own[0], 0]
        for t in own:
            if (t - at[1]).total_seconds() > gap[meter] and at[2]:
                out.append((meter, at[0], at[1] + dt.timedelta(seconds=gap[meter]), at[2]))
                at = [t, t, 0]
            at[1], at[2] = t, at[2] + 1
        out.append((meter, at[0], at[1] + dt.timedelta(seconds=gap[meter]), at[2]))
    return sorted(out)


def made(seed):
    draw = random.Random(seed)
    return [(draw.choice("ab"), T0 + dt.timedelta(seconds=600 * draw.randrange(900))) for _ in range(250)]


def test_sessions_equal_islands(spark):
    rows, gap = made(3), {"a": 1800, "b": 7200}
    frame = spark.createDataFrame([(m, t, gap[m]) for m, t in rows] + [(None, T0, 5), ("a", None, 5), ("b", T0, 0)], "meter_id string, ts timestamp_ntz, g int")
    assert sorted(map(tuple, reading_sessions(frame, "g").collect())) == brute_sessions(rows, gap)


def test_a_late_reading_joins_two_sessions_of_a_stream(spark, tmp_path):
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    steps = [[("a", at(0), 1800), ("a", at(50), 1800)], [("a", at(25), 1800), ("b", at(60), 1800)], [("z", at(5000), 1800)], [("z", at(9000), 1800)]]
    schema = "meter_id string, ts timestamp_ntz, g int"
    for step in steps:
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        reading_sessions(stream, "g")
    sink = reading_sessions(stream, "g", "2 hours").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.meter_id, r.start, r.stop, r.readings) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got[:2] == [("a", at(0), at(80), 3), ("b", at(60), at(90), 1)]
