import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from meterloom.config import Roles, Splits
from meterloom.operators import features, metrics, model, profile, scoring
from meterloom.plans import pipeline
from meterloom.session import scratch_path
from meterloom.sources import runs
from meterloom.sources.requests import request_explode

ROLES = Roles("load", ("volt",), ("load",), ("volt",))
SPLITS = Splits("2024-01-29 00:00:00", "2024-02-05 00:00:00")
HOURS = pd.date_range("2024-01-01", "2024-02-12 23:00", freq="h")


@pytest.fixture(scope="module")
def trained(spark):
    """Two meters with a daily shape and noise, one reading an hour."""
    rng = np.random.default_rng(0)
    rows = []
    for meter, scale in (("a", 1.0), ("b", 2.0)):
        for i, t in enumerate(HOURS):
            load = scale * (50 + 30 * np.sin(2 * np.pi * t.hour / 24) + rng.normal(0, 8))
            rows.append((meter, t.to_pydatetime(), i, float(load), 230.0 + float(rng.normal())))
    schema = "meter_id string, ts timestamp_ntz, row_id long, load double, volt double"
    readings = spark.createDataFrame(rows, schema)
    root = scratch_path(spark, "pipeline")
    params = model.Params(max_iter=12, patience=4, learning_rate=0.2, max_depth=5, interval_depth=3)
    result = pipeline.train_and_evaluate(readings, ROLES, SPLITS, root, params)
    return root, readings, result


def test_beats_every_baseline_and_the_profile(trained):
    _, _, result = trained
    by = {r.method: r for r in result.comparison.collect()}
    assert by["point"].MAE < min(by[m].MAE for m in by if m != "point")
    table = profile.seasonal_profile(result.hourly, ["load"], SPLITS.val_start)
    at = {"dayofweek": F.weekday("target_time"), "hour_of_day": F.hour("target_time")}
    naive = result.forecasts.withColumns(at).join(table, ["meter_id", *at])
    mae = metrics.point_metrics(naive, "load_profile").first().MAE
    assert by["point"].MAE < mae
    # The pinball loss of a bare profile is half its absolute error at q = 0.5; at the tails
    # a point forecast without a band loses the outer half of the errors.
    band = result.intervals.first()
    flat = naive.select("actual", F.col("load_profile").alias("lower"), F.col("load_profile").alias("upper"))
    bare = metrics.interval_metrics(flat).first()
    assert band["pinball_0.05"] < bare["pinball_0.05"]
    assert band["pinball_0.95"] < bare["pinball_0.95"]


def test_intervals(trained):
    _, _, result = trained
    coverage = result.intervals.first()["coverage_rate_90pct"]
    assert 75 <= coverage <= 99
    broken = result.forecasts.filter("lower > point or upper < point")
    assert broken.count() == 0
    # 168 test hours plus those of the last, incomplete day of origins
    origins = len(HOURS[HOURS >= SPLITS.test_start]) - 24
    assert result.forecasts.count() == 2 * origins * 24


def test_saved_model_scores_alike(spark, trained):
    root, _, result = trained
    again = model.load(spark, f"{root}/model")
    assert again.params == result.forecaster.params and again.roles == ROLES
    origin = "2024-02-10 12:00:00"
    bounds = model.load_bounds(spark, f"{root}/model")
    one = scoring.score_one_meter(result.forecaster, result.hourly, "a", origin, bounds)
    two = scoring.score_one_meter(again, result.hourly, "a", origin, bounds)
    assert one.count() == 24 and one.collect() == two.collect()
    whole = result.forecasts.filter((F.col("origin") == origin) & (F.col("meter_id") == "a"))
    both = whole.select("h", F.col("point").alias("p")).join(one, "h")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("point")))).first()[0] < 1e-9


def test_batch_scoring_reports_bad_meters(spark, trained):
    root, readings, _ = trained
    short = readings.filter("meter_id = 'a'").limit(100).withColumn("meter_id", F.lit("short"))
    good = readings.filter("meter_id = 'b'")
    requests = good.unionByName(short).select("meter_id", "ts", "load", "volt")
    rows = {r.meter_id: r for r in pipeline.batch_score(spark, root, requests).collect()}
    assert rows["b"].status == "ok" and len(rows["b"].predictions) == 24
    assert [p.horizon_h for p in rows["b"].predictions] == list(range(1, 25))
    assert rows["b"].forecast_origin_timestamp == "2024-02-12T23:00:00"
    assert rows["short"].status == "failed" and "100 of 168" in rows["short"].error


def test_purge_keeps_targets_inside_their_split(trained):
    root, readings, result = trained
    matrix = features.feature_matrix(result.hourly, ROLES, SPLITS.val_start)
    rows = model.training_rows(matrix, ROLES, SPLITS, purge=True)
    late = rows.filter(~F.col("is_val") & (F.col("target_time") >= F.lit(SPLITS.val_start).cast("timestamp_ntz")))
    assert late.count() == 0
    assert rows.count() < model.training_rows(matrix, ROLES, SPLITS).count()


def test_tuning_picks_the_lowest_mean(trained):
    _, _, result = trained
    matrix = features.feature_matrix(result.hourly, ROLES, SPLITS.val_start)
    base = model.Params(max_iter=3, patience=2)
    best, table = model.tune(matrix, ROLES, SPLITS, base, trials=2)
    pdf = table.toPandas()
    assert len(pdf) == 6
    winner = pdf.groupby("trial")["mae"].mean().idxmin()
    assert best == model.draw_trials(2, base)[winner]


def test_a_run_is_recorded(spark, trained):
    root, _, result = trained
    log = runs.read_runs(spark, f"{root}/runs").collect()
    assert len(log) == 1
    run = log[0]
    assert run.hyperparameters["max_iter"] == 12 and run.hyperparameters["trees"] == result.forecaster.trees
    assert run.num_features == len(result.forecaster.inputs) and run.training_time_seconds > 0
    by = {r.method: r.MAE for r in result.comparison.collect()}
    assert {m: run.metrics[m]["MAE"] for m in by} == by
    assert run.metrics["times"]["prediction_time_s"] > 0 and "coverage_rate_90pct" in run.metrics["interval"]


def test_importance_is_the_point_models(trained):
    table, = model.importance_tables(trained[2].forecaster)
    rows = {r.feature: r.importance for r in table.collect()}
    assert set(rows) == set(trained[2].forecaster.inputs) and abs(sum(rows.values()) - 1) < 1e-6


def test_the_first_trees_equal_a_smaller_fit(spark):
    rows = spark.range(400).select(F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("y", F.col("a") * 2 + F.col("b"))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).cache()

    def fit(trees):
        kind = GBTRegressor(labelCol="y", predictionCol="point", maxIter=trees, seed=3, subsamplingRate=0.8, maxDepth=3)
        return kind.fit(vectors)

    first, small = model.first_trees(fit(6), 3), fit(3)
    assert [r.point for r in first.transform(vectors).collect()] == [r.point for r in small.transform(vectors).collect()]
    assert len(first.trees) == 3 and first.featureImportances == small.featureImportances


def test_every_request_has_a_result(spark, trained):
    """Good, short, empty, unreadable and untimed requests, and two requests of one meter."""
    root, readings, _ = trained
    rows = readings.filter("meter_id = 'a'").select("ts", "load", "volt").orderBy("ts").limit(400).collect()
    entries = [f'{{"timestamp":"{r.ts.isoformat()}","load":{r.load},"volt":{r.volt}}}' for r in rows]
    history = lambda part: '{"meter_id":"a","history":[%s]}' % ",".join(part)
    texts = {
        "good": history(entries), "again": history(entries[:300]), "short": history(entries[:100]), "empty": history([]),
        "none": '{"meter_id":"a"}', "garbage": "garbage", "untimed": '{"meter_id":"a","history":[{"timestamp":"soon","load":1.0}]}',
    }
    asked = spark.createDataFrame(list(texts.items()), "id string, request string")
    exploded = request_explode(asked, ROLES, request_id="id")
    found = {r.request_id: r for r in pipeline.batch_score(spark, root, exploded).collect()}
    assert set(found) == set(texts)
    assert {k for k, r in found.items() if r.status == "ok"} == {"good", "again"}
    assert found["good"].forecast_origin_timestamp != found["again"].forecast_origin_timestamp
    assert len(found["good"].predictions) == 24
    assert all(r.error for k, r in found.items() if k not in ("good", "again"))
    assert found["short"].error == "history has 100 of 168 hours"


def test_scoring_without_a_stored_model_has_a_defined_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="point, interval, state missing"):
        model.load(spark, str(tmp_path / "none"))
    (tmp_path / "half" / "point").mkdir(parents=True)
    with pytest.raises(FileNotFoundError, match="interval, state missing"):
        model.load(spark, str(tmp_path / "half"))


def test_few_training_rows_meet_in_few_tasks(spark, monkeypatch):
    """Each tree runs jobs over all rows, so partitions go by the rows and not by where they come from."""
    rows = spark.range(0, 300, 1, 12).select(
        F.lit("m").alias("meter_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("hour"),
        F.lit(1).alias("h"), F.rand(1).alias("y"),
    )
    few = model.dealt(rows)
    assert few.rdd.getNumPartitions() == 1 and few.collect() == sorted(rows.collect())
    monkeypatch.setattr(model, "TASK_ROWS", 100)
    some = model.dealt(rows)
    assert some.rdd.getNumPartitions() == 3 and sorted(some.collect()) == sorted(rows.collect())
    monkeypatch.setattr(model, "TASK_ROWS", 10)
    assert model.dealt(rows).rdd.getNumPartitions() == 12
