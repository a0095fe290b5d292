"""Queries over fitted models.

What SQL can derive without the fit is compared: keys, counts, times, actuals, states, and that bounds,
metrics and differences are as they must be. Accuracy itself is tested in pytest.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.config import CV_FOLDS, TOP_FEATURES, TUNING_TRIALS
from meterloom.functions.calendar import epoch_hour
from meterloom.operators import features as feat
from meterloom.operators import metrics, model, reports, scoring
from meterloom.plans import standin
from meterloom.plans.registry import query, rounded
from meterloom.plans.standin import COLS, ROLES, SPLITS
from meterloom.session import scratch_path

PARAMS = model.Params()
ORIGIN = "2024-01-28 12:00:00"


# -- built once per session and data set ---------------------------------------
@lru_cache
def stored_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hourly")
    standin.hourly(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.clip_bounds(stored_hourly(spark, sf_dir), COLS, SPLITS.val_start)


@lru_cache
def stored_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "matrix")
    matrix = feat.feature_matrix(stored_hourly(spark, sf_dir), ROLES, SPLITS.val_start)
    matrix.write.parquet(path)
    return spark.read.parquet(path)


@lru_cache
def fitted(spark: SparkSession, sf_dir: str) -> model.Forecaster:
    return model.fit(stored_matrix(spark, sf_dir), ROLES, SPLITS, PARAMS)


def _test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit(SPLITS.test_start).cast("timestamp_ntz")
    test = stored_matrix(spark, sf_dir).filter(F.col("hour") >= start)
    return model.score_long(fitted(spark, sf_dir), test)


# -- the rows that models see, in SQL --------------------------------------------
# A feature row needs 169 hours before it, a training row 24 after it as well.
_SQL_ROWS = f"""{standin.sql_hourly()}, placed AS (
SELECT meter_id, hour, load, row_number() OVER (PARTITION BY meter_id ORDER BY hour) - 1 AS rn,
  count(*) OVER (PARTITION BY meter_id) AS n FROM hourly),
matrix AS (SELECT * FROM placed WHERE rn >= 169 AND rn < n - 24),
steps AS (SELECT CAST(unnest(range(1, 25)) AS INT) AS h),
test AS (SELECT meter_id, hour AS origin, h, hour + to_hours(h) AS target_time
  FROM matrix, steps WHERE hour >= TIMESTAMP '{SPLITS.test_start}')"""


def _finite(*columns: str) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e300)
    return ok.alias("finite")


def _ordered() -> Column:
    return ((F.col("lower") <= F.col("point")) & (F.col("point") <= F.col("upper"))).alias("ordered")


# -- queries ---------------------------------------------------------------------
@query("fit_point", f"""{_SQL_ROWS} SELECT h, CAST(count(*) AS BIGINT) AS n, TRUE AS finite FROM test GROUP BY h""")
def fit_point(spark, sf_dir):
    """Test accuracy of the point model by horizon: rows, and metrics that are numbers."""
    scores = _test_scores(spark, sf_dir)
    table = metrics.point_metrics(scores, by=["h"])
    return scores.groupBy("h").agg(F.count("*").alias("n")).join(table, "h").select("h", "n", _finite("MAE", "RMSE", "MAPE", "R2"))


@query(
    "fit_quantile",
    f"""{_SQL_ROWS} SELECT h, CAST(count(*) AS BIGINT) AS n, TRUE AS finite, TRUE AS in_range FROM test GROUP BY h""",
)
def fit_quantile(spark, sf_dir):
    """Pinball loss and coverage of the interval by horizon: rows, numbers, coverage from 0 to 100."""
    scores = _test_scores(spark, sf_dir)
    table = metrics.interval_metrics(scores, by=["h"])
    table = scores.groupBy("h").agg(F.count("*").alias("n")).join(table, "h")
    losses = ("`pinball_0.05`", "`pinball_0.95`", "coverage_rate_90pct")
    return table.select("h", "n", _finite(*losses), F.col("coverage_rate_90pct").between(0, 100).alias("in_range"))


@query(
    "early_stopping",
    f"""{_SQL_ROWS} SELECT hour >= TIMESTAMP '{SPLITS.val_start}' AS is_val, CAST(24 * count(*) AS BIGINT) AS "rows",
{PARAMS.max_iter} AS cap, TRUE AS within_cap FROM matrix WHERE hour < TIMESTAMP '{SPLITS.test_start}' GROUP BY 1""",
)
def early_stopping(spark, sf_dir):
    """Rows that are fitted and that stop the fit, the cap, and whether the kept trees respect it."""
    rows = model.training_rows(stored_matrix(spark, sf_dir), ROLES, SPLITS)
    kept = fitted(spark, sf_dir).trees
    per_split = rows.groupBy("is_val").agg(F.count("*").alias("rows"))
    return per_split.select(
        "is_val", "rows", F.lit(PARAMS.max_iter).alias("cap"), F.lit(1 <= kept <= PARAMS.max_iter).alias("within_cap")
    )


@query(
    "tune_random_search",
    f"""SELECT CAST(unnest(range({TUNING_TRIALS})) AS INT) AS trial, CAST({CV_FOLDS} AS BIGINT) AS folds, TRUE AS finite,
CAST(1 AS BIGINT) AS best_trials""",
)
def tune_random_search(spark, sf_dir):
    """Folds of each trial, whether its mean validation MAE is a number, and how many trials are best."""
    _, table = model.tune(stored_matrix(spark, sf_dir), ROLES, SPLITS)
    best = F.lit(model.best_trial(table).count()).cast("long").alias("best_trials")
    means = table.groupBy("trial").agg(F.avg("mae").alias("mae"), F.count("*").alias("folds"))
    return means.select("trial", "folds", _finite("mae"), best)


@query(
    "score_long",
    f"""{_SQL_ROWS} SELECT t.meter_id, origin, h, target_time, round(CAST(a.load AS DOUBLE), 3) + 0.0 AS actual,
TRUE AS ordered, TRUE AS finite
FROM test t JOIN hourly a ON a.meter_id = t.meter_id AND a.hour = t.target_time""",
)
def score_long(spark, sf_dir):
    """Every test forecast with its actual; the bounds enclose the point."""
    scores = _test_scores(spark, sf_dir)
    kept = ["meter_id", "origin", "h", "target_time", "actual"]
    return rounded(scores.select(*kept, _ordered(), _finite("point", "lower", "upper")), 3)


@query(
    "feature_importance_topk",
    f"""SELECT CAST(unnest(range(1, {TOP_FEATURES + 1})) AS INT) AS rank, TRUE AS falling, TRUE AS in_range""",
)
def feature_importance_topk(spark, sf_dir):
    """The most important inputs of the point model: ranks, falling, from 0 to 1."""
    tables = model.importance_tables(fitted(spark, sf_dir))
    top = reports.top_k(reports.mean_importance(tables), "mean_importance", "feature")
    # At most TOP_FEATURES rows.
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_importance"), "feature")
    value = F.col("mean_importance")
    return top.select(
        F.row_number().over(order).alias("rank"),
        (value <= F.coalesce(F.lag(value).over(order), value)).alias("falling"),
        value.between(0, 1).alias("in_range"),
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories up to ORIGIN; one meter has too few hours, one just misses the deepest lag."""
    table = stored_hourly(spark, sf_dir)
    end = F.lit(ORIGIN).cast("timestamp_ntz")
    kept = F.when(F.col("meter_id") == "click", 100).when(F.col("meter_id") == "view", 168).otherwise(10_000)
    age = epoch_hour(end) - epoch_hour(F.col("hour"))
    recent = table.filter((F.col("hour") <= end) & (age < kept))
    return recent.select("meter_id", F.col("hour").alias("ts"), *COLS)


@query(
    "batch_score_meters",
    f"""{standin.sql_hourly()}, r AS (SELECT meter_id, count(*) AS hours FROM hourly
WHERE hour <= TIMESTAMP '{ORIGIN}' AND date_diff('hour', hour, TIMESTAMP '{ORIGIN}') <
  CASE meter_id WHEN 'click' THEN 100 WHEN 'view' THEN 168 ELSE 10000 END GROUP BY meter_id)
SELECT meter_id, CASE WHEN hours >= 170 THEN '{ORIGIN.replace(" ", "T")}' END AS forecast_origin_timestamp,
CAST(CASE WHEN hours >= 170 THEN 24 END AS DOUBLE) AS steps,
CASE WHEN hours >= 170 THEN 'ok' ELSE 'failed' END AS status,
CASE WHEN hours < 168 THEN 'history has ' || hours || ' of 168 hours'
  WHEN hours < 170 THEN 'no complete feature row; 170 gap-free hours are needed' END AS error FROM r""",
)
def batch_score_meters(spark, sf_dir):
    scored = scoring.batch_score_meters(
        fitted(spark, sf_dir), _requests(spark, sf_dir), _bounds(spark, sf_dir)
    )
    steps = F.when(F.col("predictions").isNotNull(), F.size("predictions").cast("double"))
    return scored.select("meter_id", "forecast_origin_timestamp", steps.alias("steps"), "status", "error")


@query(
    "score_one_meter",
    f"""WITH steps AS (SELECT CAST(unnest(range(1, 25)) AS INT) AS h)
SELECT 'purchase' AS meter_id, TIMESTAMP '{ORIGIN}' AS origin, h, TIMESTAMP '{ORIGIN}' + to_hours(h) AS target_time,
TRUE AS ordered, TRUE AS finite FROM steps""",
)
def score_one_meter(spark, sf_dir):
    one = scoring.score_one_meter(
        fitted(spark, sf_dir), stored_hourly(spark, sf_dir), "purchase", ORIGIN, _bounds(spark, sf_dir)
    )
    return one.select("meter_id", "origin", "h", "target_time", _ordered(), _finite("point", "lower", "upper"))


@query(
    "model_save_load",
    """SELECT CAST(unnest(range(1, 25)) AS INT) AS h, (SELECT count(DISTINCT event_type) FROM events) AS meters,
CAST(0 AS DOUBLE) AS point, CAST(0 AS DOUBLE) AS lower, CAST(0 AS DOUBLE) AS upper""",
)
def model_save_load(spark, sf_dir):
    """Largest difference between the forecasts of a model and of its reloaded copy."""
    path = scratch_path(spark, "model")
    original = fitted(spark, sf_dir)
    model.save(original, path, _bounds(spark, sf_dir))
    again = model.load(spark, path)
    row = feat.origin_features(
        stored_hourly(spark, sf_dir), ROLES, ORIGIN, model.load_bounds(spark, path)
    )
    keys = ["meter_id", "origin", "h"]
    renamed = [F.col(c).alias(f"{c}_again") for c in ("point", "lower", "upper")]
    both = model.score_long(original, row).join(
        model.score_long(again, row).select(*keys, *renamed), keys
    )
    gaps = [F.max(F.abs(F.col(c) - F.col(f"{c}_again"))).alias(c) for c in ("point", "lower", "upper")]
    return both.groupBy("h").agg(F.count("*").alias("meters"), *gaps)
