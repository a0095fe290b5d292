"""The batch pipeline from readings to metrics, and scoring with its result.

Tables that several steps read are written once below ``root``: the hourly table, the feature
matrix and the scored test set. They also bound what a lost executor has to redo.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.config import MAX_GAP, Roles, Splits
from meterloom.operators import baselines, features, gaps, metrics, model, profile, resample, scoring
from meterloom.sources import runs
from meterloom.sources.hourly_table import hourly_table

METHODS = ("point", *baselines.BASELINES)


def clean_hourly(
    readings: DataFrame,
    roles: Roles,
    splits: Splits,
    max_gap: int = MAX_GAP,
    empty_sum: str = "zero",
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Readings to the gap-free hourly table: meter_id, hour, values and imputation flags.

    ``store`` writes the hours before imputation and reads them back, so that the profile and what
    it fills don't each run the gap fill.
    """
    filled = gaps.interpolate_short_gaps(readings, roles.all_cols, max_gap)
    hourly = resample.resample_hourly(
        filled, roles, empty_sum, bounds=resample.meter_bounds(readings)
    )
    if store is not None:
        hourly = store(hourly)
    return profile.profile_impute(hourly, roles.all_cols, splits.val_start)


@dataclass(frozen=True)
class Result:
    forecaster: model.Forecaster
    hourly: DataFrame
    forecasts: DataFrame  # test origins x 24 with actual, model and baselines
    comparison: DataFrame
    intervals: DataFrame
    robustness: DataFrame


def _store(spark: SparkSession, table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def train_and_evaluate(
    readings: DataFrame,
    roles: Roles,
    splits: Splits,
    root: str,
    params: model.Params | None = None,
    tuning_trials: int = 0,
    max_gap: int = MAX_GAP,
) -> Result:
    """Clean, build features, tune (if asked), fit, save, score the test set and report."""
    spark = readings.sparkSession

    def raw(table: DataFrame) -> DataFrame:
        return _store(spark, table, f"{root}/raw_hourly")

    hourly = hourly_table(
        spark, f"{root}/hourly", lambda: clean_hourly(readings, roles, splits, max_gap, store=raw)
    )
    bounds = _store(
        spark, features.clip_bounds(hourly, roles.all_cols, splits.val_start), f"{root}/clip_bounds"
    )
    matrix = _store(
        spark, features.feature_matrix(hourly, roles, splits.val_start), f"{root}/matrix"
    )
    params = params or model.Params()
    began = time.monotonic()
    if tuning_trials:
        # The search spends its own budget of trees; what it finds is fitted with ``params``' budget.
        budget = replace(params, max_iter=model.TUNING.max_iter, patience=model.TUNING.patience)
        found, trials = model.tune(matrix, roles, splits, budget, tuning_trials)
        params = replace(found, max_iter=params.max_iter, patience=params.patience)
        _store(spark, trials, f"{root}/trials")
    tuned = time.monotonic()
    forecaster = model.fit(matrix, roles, splits, params)
    model.save(forecaster, f"{root}/model", bounds)
    fitted = time.monotonic()

    start = F.lit(splits.test_start).cast("timestamp_ntz")
    scored = model.score_long(forecaster, matrix.filter(F.col("hour") >= start))
    naive = baselines.baselines_long(hourly, roles.target, splits.test_start)
    keys = ["meter_id", "origin", "h"]
    long = _store(
        spark,
        scored.join(naive.select(*keys, *baselines.BASELINES), keys),
        f"{root}/forecasts",
    )
    predicted = time.monotonic()
    medians = metrics.train_median(hourly, roles.target, splits.val_start)
    comparison = metrics.method_comparison(long, METHODS)
    intervals = metrics.interval_metrics(long)
    times = {"tuning_time_s": tuned - began, "training_time_s": fitted - tuned, "prediction_time_s": predicted - fitted}
    _append_run(spark, root, forecaster, comparison, intervals, times)
    return Result(
        forecaster,
        hourly,
        long,
        comparison,
        intervals,
        metrics.robustness_report(metrics.with_slices(long, medians)),
    )


def _append_run(
    spark: SparkSession, root: str, forecaster: model.Forecaster, comparison: DataFrame, intervals: DataFrame, times: dict[str, float]
) -> None:
    """One record of parameters, times and metrics (a row a method, one of intervals) below ``root``."""
    scores = {
        r.method: {k: float(v) for k, v in r.asDict().items() if k != "method" and v is not None} for r in comparison.collect()
    }
    scores["interval"] = {k: float(v) for k, v in intervals.first().asDict().items() if v is not None}
    scores["times"] = {k: float(v) for k, v in times.items()}
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    used = {k: float(v) for k, v in asdict(forecaster.params).items()} | {"trees": float(forecaster.trees)}
    record = (f"{now:%Y%m%d_%H%M%S_%f}", now, used, len(forecaster.inputs), float(times["training_time_s"]), scores)
    runs.append_runs(spark.createDataFrame([record], runs.RUN_SCHEMA), f"{root}/runs")


def batch_score(spark: SparkSession, root: str, readings: DataFrame) -> DataFrame:
    """Score request readings with the saved model and its clip bounds."""
    forecaster = model.load(spark, f"{root}/model")
    bounds = model.load_bounds(spark, f"{root}/model")
    return scoring.batch_score_meters(forecaster, readings, bounds)
