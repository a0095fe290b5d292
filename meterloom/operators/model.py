"""The fitted forecaster: one boosted point model over all horizons, and an interval tree.

Training rows are (origin, h): the origin's features, the calendar of the target hour and h
itself. One global fit replaces a model per horizon, so the work is one distributed job. The
fits read their input several times: hand them a stored feature matrix.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterloom.config import (
    CV_FOLDS,
    HORIZON,
    QUANTILES,
    SEARCH,
    TUNING_HORIZON,
    TUNING_PATIENCE,
    TUNING_TREES,
    TUNING_TRIALS,
    Roles,
    Splits,
    feature_columns,
)
from meterloom.functions.calendar import CALENDAR_COLUMNS
from meterloom.functions.scalars import repaired_lower, repaired_upper
from meterloom.operators.features import horizon_long, with_calendar

KEYS = ("meter_id", "hour")
#: Training rows that a task of a fit has at least, where the cluster has tasks to spare.
TASK_ROWS = 5_000


@dataclass(frozen=True)
class Params:
    """Boosting parameters; ``max_iter`` caps the trees, validation may stop earlier.

    ``min_rows`` is per horizon: a training row occurs once for each of them.
    """

    max_iter: int = 1000
    patience: int = 50
    min_rows: int = 20
    learning_rate: float = 0.05
    max_depth: int = 6
    feature_fraction: float = 0.8
    row_fraction: float = 0.8
    interval_depth: int = 5
    # Leaves with fewer calibration rows than this use the interval of all rows.
    min_leaf_rows: int = 50
    seed: int = 42


#: What a trial of the search may spend.
TUNING = Params(max_iter=TUNING_TREES, patience=TUNING_PATIENCE)


@dataclass(frozen=True)
class Forecaster:
    point: PipelineModel
    interval: DecisionTreeRegressionModel
    # leaf -> (lower, upper) offset from the point; at most 2 ** interval_depth entries
    bands: dict[int, tuple[float, float]]
    default_band: tuple[float, float]
    params: Params
    roles: Roles

    @property
    def trees(self) -> int:
        return len(self.point.stages[-1].trees)

    @property
    def inputs(self) -> list[str]:
        return model_inputs(self.roles)


def model_inputs(roles: Roles) -> list[str]:
    return [*feature_columns(roles), *CALENDAR_COLUMNS, "h"]


def _at(time: str) -> Column:
    return F.lit(time).cast("timestamp_ntz")


# -- rows --------------------------------------------------------------------
def training_rows(matrix: DataFrame, roles: Roles, splits: Splits, purge: bool = False) -> DataFrame:
    """(origin, h) rows before the test period with ``y`` and ``is_val``.

    ``purge`` leaves out rows whose target lies past the end of their own split.
    """
    before = matrix.filter(F.col("hour") < _at(splits.test_start))
    long = with_calendar(horizon_long(before, [*KEYS, *feature_columns(roles)], value="y"))
    is_val = F.col("hour") >= _at(splits.val_start)
    rows = long.withColumn("is_val", is_val)
    if purge:
        end = F.when(is_val, _at(splits.test_start)).otherwise(_at(splits.val_start))
        rows = rows.filter(F.col("target_time") < end)
    return rows


def scoring_rows(features: DataFrame, roles: Roles) -> DataFrame:
    """(origin, h) rows of feature rows; actuals are kept where the targets are present."""
    keys = [*KEYS, *feature_columns(roles)]
    if "target_h1" in features.columns:
        return with_calendar(horizon_long(features, keys))
    steps = F.explode(F.sequence(F.lit(1), F.lit(HORIZON))).alias("h")
    return with_calendar(features.select(*keys, steps))


# -- fitting -----------------------------------------------------------------
def best_iteration(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Trees to keep, and whether ``patience`` flat rounds followed the best one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` in as many partitions as they fill, where those are fewer than the cluster has cores.

    Each tree takes several jobs over all rows; where rows are few, starting tasks is what jobs cost. Rows lie
    in the order of their keys, so that a recomputed partition equals the first one. More rows stay where they are.
    """
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    if tasks >= rows.sparkSession.sparkContext.defaultParallelism:
        return rows
    keys = [*KEYS, "h", "y"]
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys)


def fit_point(rows: DataFrame, roles: Roles, params: Params, horizons: int = HORIZON) -> PipelineModel:
    """Boosted trees over all horizons; rows with ``is_val`` only decide how many trees to keep.

    The built-in validation stops at the first flat round, so patience is applied to the
    validation loss of every prefix of a fitted model. The number of trees tried doubles until
    the best prefix is followed by ``patience`` flat rounds or the cap is reached; the model that is
    kept consists of the first trees of that fit.
    """
    assembler = VectorAssembler(inputCols=model_inputs(roles), outputCol="features")

    def vectors(some: DataFrame) -> DataFrame:
        return assembler.transform(some).select("features", F.col("y").cast("double"))

    train, val = vectors(dealt(rows.filter(~F.col("is_val")))), vectors(rows.filter("is_val"))

    def boost(trees: int) -> GBTRegressionModel:
        return GBTRegressor(
            labelCol="y",
            predictionCol="point",
            maxIter=trees,
            stepSize=params.learning_rate,
            maxDepth=params.max_depth,
            minInstancesPerNode=params.min_rows * horizons,
            featureSubsetStrategy=str(params.feature_fraction),
            subsamplingRate=params.row_fraction,
            seed=params.seed,
        ).fit(train)

    tried = min(params.max_iter, params.patience + max(1, params.patience // 4))
    while True:
        booster = boost(tried)
        kept, settled = best_iteration(booster.evaluateEachIteration(val, "squared"), params.patience)
        if settled or tried == params.max_iter:
            break
        tried = min(params.max_iter, 2 * tried)
    return PipelineModel([assembler, booster if kept == tried else first_trees(booster, kept)])


def first_trees(booster: GBTRegressionModel, kept: int) -> GBTRegressionModel:
    """The model of the first ``kept`` trees, which equals a fit of so many with the same seed."""
    gateway = SparkSession.active().sparkContext._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, kept), gateway.new_array(gateway.jvm.double, kept)
    for i, (tree, weight) in enumerate(zip(booster._java_obj.trees()[:kept], booster.treeWeights[:kept], strict=True)):
        trees[i], weights[i] = tree, weight
    made = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(
        f"{booster.uid}_{kept}", trees, weights, booster.numFeatures
    )
    return GBTRegressionModel(made).setFeaturesCol("features").setPredictionCol(booster.getPredictionCol())


def fit_interval(
    rows: DataFrame, point: PipelineModel, params: Params
) -> tuple[DecisionTreeRegressionModel, dict[int, tuple[float, float]], tuple[float, float]]:
    """Conditional residual quantiles.

    A tree groups rows of like error size (learned on training rows); each leaf's quantiles
    come from validation rows, which the point model has not fitted. The quantile sketch
    merges partial results, and only one row per leaf (2 ** depth at most) is fetched.
    """
    scored = point.transform(rows).withColumn("residual", F.col("y") - F.col("point"))
    tree = DecisionTreeRegressor(
        labelCol="size",
        leafCol="leaf",
        predictionCol="expected_size",
        maxDepth=params.interval_depth,
        minInstancesPerNode=params.min_rows * HORIZON,
        seed=params.seed,
    ).fit(scored.filter(~F.col("is_val")).select("features", F.abs("residual").alias("size")))
    calibration = tree.transform(scored.filter("is_val").select("features", "residual"))
    quantiles = F.percentile_approx("residual", list(QUANTILES), 10_000)
    per_leaf = (
        calibration.groupingSets([[F.col("leaf")], []], "leaf")
        .agg(quantiles.alias("q"), F.count("*").alias("n"))
        .collect()
    )
    overall = next((float(r.q[0]), float(r.q[1])) for r in per_leaf if r.leaf is None)
    bands = {
        int(r.leaf): (float(r.q[0]), float(r.q[1]))
        for r in per_leaf
        if r.leaf is not None and r.n >= params.min_leaf_rows
    }
    return tree, bands, overall


def fit(
    matrix: DataFrame, roles: Roles, splits: Splits, params: Params | None = None, purge: bool = False
) -> Forecaster:
    params = params or Params()
    rows = training_rows(matrix, roles, splits, purge)
    point = fit_point(rows, roles, params)
    tree, bands, overall = fit_interval(rows, point, params)
    return Forecaster(point, tree, bands, overall, params, roles)


# -- scoring -----------------------------------------------------------------
def score_long(model: Forecaster, features: DataFrame) -> DataFrame:
    """(meter_id, origin, h, target_time, point, lower, upper[, actual]), bounds repaired."""
    rows = scoring_rows(features, model.roles)
    scored = model.interval.transform(model.point.transform(rows))

    def offset(side: int) -> Column:
        default = F.lit(model.default_band[side])
        if not model.bands:
            return default
        pairs = [F.lit(v) for leaf, band in model.bands.items() for v in (leaf, band[side])]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("leaf").cast("int")), default)

    point = F.col("point")
    actual = ["actual"] if "actual" in rows.columns else []
    return scored.select(
        "meter_id",
        F.col("hour").alias("origin"),
        "h",
        "target_time",
        *actual,
        point,
        repaired_lower(point + offset(0), point).alias("lower"),
        repaired_upper(point + offset(1), point).alias("upper"),
    )


# -- folds and tuning ----------------------------------------------------------
def ts_cv_folds(origins: DataFrame, folds: int = CV_FOLDS) -> DataFrame:
    """Expanding-window folds over the distinct hours: (hour, rank, n, fold).

    Fold j validates on ``fold == j`` and trains on ``fold < j``. All meters share the cuts.
    The global order runs over distinct hours only, which the calendar bounds (8,766 a year).
    """
    hours = origins.select("hour").distinct()
    everything = Window.partitionBy(F.lit(0))
    ranked = hours.select(
        "hour",
        (F.row_number().over(everything.orderBy("hour")) - 1).cast("long").alias("rank"),
        F.count("*").over(everything).alias("n"),
    )
    size = F.floor(F.col("n") / (folds + 1))
    first = F.col("n") - size * folds
    fold = F.when(F.col("rank") < first, 0).otherwise(F.floor((F.col("rank") - first) / size) + 1)
    return ranked.withColumn("fold", fold.cast("int"))


def draw_trials(trials: int, base: Params) -> list[Params]:
    """Seeded random search over learning rate, depth, feature and row fraction."""
    draw = random.Random(base.seed)
    return [
        replace(
            base,
            learning_rate=round(draw.uniform(*SEARCH["learning_rate"]), 4),
            max_depth=draw.randint(*SEARCH["max_depth"]),
            feature_fraction=round(draw.uniform(*SEARCH["feature_fraction"]), 3),
            row_fraction=round(draw.uniform(*SEARCH["row_fraction"]), 3),
        )
        for _ in range(trials)
    ]


def tune(
    matrix: DataFrame,
    roles: Roles,
    splits: Splits,
    base: Params | None = None,
    trials: int = TUNING_TRIALS,
    folds: int = CV_FOLDS,
    parallelism: int = 4,
) -> tuple[Params, DataFrame]:
    """Random search scored by mean validation MAE at one horizon over expanding folds.

    Returns the best parameters and the (trial, fold, mae, parameters...) table. Each fit is a
    distributed job; ``parallelism`` fits are in flight at a time.
    """
    spark = matrix.sparkSession
    base = base or TUNING
    candidates = draw_trials(trials, base)
    before = matrix.filter(F.col("hour") < _at(splits.test_start))
    at_h = before.select(
        *KEYS,
        *feature_columns(roles),
        F.lit(TUNING_HORIZON).alias("h"),
        F.col(f"target_h{TUNING_HORIZON}").alias("y"),
    )
    labelled = with_calendar(at_h.join(ts_cv_folds(before, folds).select("hour", "fold"), "hour"))
    labelled = labelled.persist()
    try:

        def run(job: tuple[int, int]) -> tuple[int, int, float]:
            trial, fold = job
            seen = labelled.filter(F.col("fold") <= fold).withColumn("is_val", F.col("fold") == fold)
            model = fit_point(seen, roles, candidates[trial], horizons=1)
            error = F.avg(F.abs(F.col("y") - F.col("point")))
            mae = model.transform(seen.filter("is_val")).agg(error).first()[0]
            return trial, fold, float(mae)

        jobs = [(t, f) for t in range(trials) for f in range(1, folds + 1)]
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(run, jobs))
    finally:
        labelled.unpersist()
    table = spark.createDataFrame(
        [
            (t, f, mae, c.learning_rate, c.max_depth, c.feature_fraction, c.row_fraction)
            for t, f, mae in scores
            for c in [candidates[t]]
        ],
        "trial int, fold int, mae double, learning_rate double, max_depth int, "
        "feature_fraction double, row_fraction double",
    )
    best = best_trial(table).first().trial
    return candidates[best], table


def best_trial(table: DataFrame) -> DataFrame:
    """(trial, mae) of the lowest mean MAE over folds."""
    means = table.groupBy("trial").agg(F.avg("mae").alias("mae"))
    best = F.min_by(F.struct("trial", "mae"), F.struct("mae", "trial"))
    return means.agg(best.alias("b")).select("b.trial", "b.mae")


# -- importance, persistence -----------------------------------------------------
def importance_tables(model: Forecaster) -> list[DataFrame]:
    """(feature, importance) of the point models, one row per input.

    The interval tree is left out: it predicts the size of errors, not the load.
    """
    rows = zip(model.inputs, model.point.stages[-1].featureImportances.toArray(), strict=True)
    named = [(name, float(v)) for name, v in rows]
    return [SparkSession.active().createDataFrame(named, "feature string, importance double")]


_STATE = (
    "bands map<int, array<double>>, default_band array<double>, params map<string, double>, "
    "target string, exog array<string>, sum_cols array<string>, mean_cols array<string>"
)


def save(model: Forecaster, path: str, bounds: DataFrame | None = None) -> None:
    """Write both models, the leaf bands and, so that scoring clips as training did, the
    per-meter clip bounds."""
    model.point.write().overwrite().save(f"{path}/point")
    model.interval.write().overwrite().save(f"{path}/interval")
    roles = model.roles
    state = (
        {leaf: list(band) for leaf, band in model.bands.items()},
        list(model.default_band),
        {k: float(v) for k, v in asdict(model.params).items()},
        roles.target,
        list(roles.exog),
        list(roles.sum_cols),
        list(roles.mean_cols),
    )
    spark = SparkSession.active()
    spark.createDataFrame([state], _STATE).write.mode("overwrite").parquet(f"{path}/state")
    if bounds is not None:
        bounds.write.mode("overwrite").parquet(f"{path}/clip_bounds")


def load(spark: SparkSession, path: str) -> Forecaster:
    """The model stored at ``path``; FileNotFoundError where there is none, or only part of one."""
    missing = [part for part in ("point", "interval", "state") if not _stored(spark, f"{path}/{part}")]
    if missing:
        raise FileNotFoundError(f"no model at {path}: {', '.join(missing)} missing")
    state = spark.read.schema(_STATE).parquet(f"{path}/state").first()
    kinds = Params.__annotations__
    whole = {k for k, kind in kinds.items() if kind == "int"}
    params = {k: int(v) if k in whole else v for k, v in state.params.items()}
    return Forecaster(
        PipelineModel.load(f"{path}/point"),
        DecisionTreeRegressionModel.load(f"{path}/interval"),
        {leaf: (band[0], band[1]) for leaf, band in state.bands.items()},
        (state.default_band[0], state.default_band[1]),
        Params(**params),
        Roles(state.target, tuple(state.exog), tuple(state.sum_cols), tuple(state.mean_cols)),
    )


def _stored(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def load_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/clip_bounds")
