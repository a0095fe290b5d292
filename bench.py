"""Time the pipeline's stages at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Meters are the users of the ``events`` table. Each stage writes its whole result; later stages
read the stored hourly table and feature matrix, as the batch pipeline does. The stages run
twice: ``queries`` is the second pass, the first one (JVM cold) is reported beside it. The
models are fitted on the five-meter matrix, by event type.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.config import feature_columns
from meterloom.operators import baselines, metrics, model, scoring
from meterloom.operators import features as feat
from meterloom.plans import queries_models, standin
from meterloom.plans.queries_ingest import TEXT_COLUMNS, text_path
from meterloom.plans.standin import COLS, ROLES, SPLITS
from meterloom.session import local_session
from meterloom.sources import readings

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
METER = "user_id"


def one_pass(spark: SparkSession, text: str, small_matrix: DataFrame, root: str) -> dict[str, float]:
    """Seconds of each stage, everything written in full."""
    times: dict[str, float] = {}

    def stage(name: str, build: Callable[[], DataFrame], table: str | None = None) -> DataFrame:
        start = time.time()
        result = build()
        if table is None:
            result.write.format("noop").mode("overwrite").save()
        else:
            result.write.parquet(f"{root}/{table}")
        times[name] = round(time.time() - start, 3)
        return result if table is None else spark.read.parquet(f"{root}/{table}")

    def ingest() -> DataFrame:
        raw = readings.scan_delimited(spark, text, TEXT_COLUMNS)
        return readings.coerce_numeric(readings.parse_event_time(raw), ["load", "level"])

    stage("ingest_text", ingest)
    stage("gap_fill", lambda: standin.filled(spark, SF_DIR, METER))
    hourly = stage("hourly_table", lambda: standin.hourly(spark, SF_DIR, METER), "hourly")
    matrix = stage(
        "feature_matrix", lambda: feat.feature_matrix(hourly, ROLES, SPLITS.val_start), "matrix"
    )
    long = stage(
        "baselines",
        lambda: baselines.baselines_long(hourly, ROLES.target, SPLITS.test_start),
        "baselines",
    )
    stage("method_comparison", lambda: metrics.method_comparison(long, baselines.BASELINES))

    def slices() -> DataFrame:
        medians = metrics.train_median(hourly, ROLES.target, SPLITS.val_start)
        return metrics.robustness_report(metrics.with_slices(long, medians), "daily_naive")

    stage("robustness_report", slices)

    start = time.time()
    forecaster = model.fit(small_matrix, ROLES, SPLITS, queries_models.PARAMS)
    # The training bounds are stored beside a model: scoring clips as training did without a look at the history.
    feat.clip_bounds(hourly, COLS, SPLITS.val_start).write.parquet(f"{root}/model/clip_bounds")
    times["fit_models"] = round(time.time() - start, 3)

    def score_latest() -> DataFrame:
        bounds = model.load_bounds(spark, f"{root}/model")
        # The hourly table has no holes: the newest features need what they reach, no more.
        recent = scoring.tail_of(hourly, feat.HISTORY_REACH + 1)
        frame = feat.feature_frame(recent, ROLES, bounds, with_targets=False)
        latest = feat.latest_origin(feat.complete_cases(frame, feature_columns(ROLES)))
        return model.score_long(forecaster, feat.downcast(latest))

    stage("score_latest", score_latest)
    test = matrix.filter(F.col("hour") >= F.lit(SPLITS.test_start).cast("timestamp_ntz"))
    stage("score_test_set", lambda: model.score_long(forecaster, test))
    return times


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="meterloom-bench-")
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), **{"spark.checkpoint.dir": scratch})
    text = text_path(spark, SF_DIR)
    small = queries_models.stored_matrix(spark, SF_DIR)
    first = one_pass(spark, text, small, f"{scratch}/first")
    second = one_pass(spark, text, small, f"{scratch}/second")
    hours = spark.read.parquet(f"{scratch}/second/hourly").count()
    print(
        json.dumps(
            {
                "metric": "pipeline_total",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "first_pass_cold_jvm": first,
                "cpus": CPUS,
                "meter_hours": hours,
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
