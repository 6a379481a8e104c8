"""Feature preparation, chronological splits, training and forecasting with ``pyspark.ml``."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import ieee_div, number
from tideframe.functions.numeric import numeric_columns
from tideframe.operators.clean import ffill_bfill, median_impute
from tideframe.operators.drift import drift_ratio
from tideframe.operators.evaluate import best_model, cv_scores, cv_summary, evaluate_forecast, evaluate_split
from tideframe.operators.gram import ridge_cv_values
from tideframe.operators.publish import at_time, first_row, latest_row, time_range
from tideframe.plans.ordered import HOURLY, Series, ordinal
from tideframe.plans.quantiles import column_facts
from tideframe.session import materialize

log = logging.getLogger(__name__)

# Columns that are never features, split and model parameters.
NOT_FEATURES = {
    "id", "symbol", "name", "last_updated", "timestamp", "extraction_timestamp", "current_price", "roi",
}
TARGET = "price"
TEST_SHARE = 0.2
FOLDS = 3
LEAST_PARTITIONS, PARTITION_ROWS = 4, 200_000
SEED = 42
FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "featureSubsetStrategy": "all", "seed": SEED}
BOOSTING = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "minInstancesPerNode": 2, "seed": SEED}
RIDGE_ALPHA = 1.0
RUNS_SCHEMA = "run_ts string, name string, path string, features array<string>, is_best boolean"
#: What follows the run in a stored name; a run may hold underscores, so it is cut off by its length.
MODEL_TYPE = "substring(name, char_length(run_ts) + 2)"
MODELS = ("random_forest", "gradient_boosting", "ridge")


def select_features(df: DataFrame, exclude_target: bool = False) -> list[str]:
    """Numeric columns that are not on the exclusion list. The target stays in unless asked otherwise."""
    return numeric_columns(df, NOT_FEATURES | ({TARGET} if exclude_target else set()))


def require_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exactly the named columns in their order, or an error naming the missing ones."""
    missing = sorted(set(features) - set(df.columns))
    if missing:
        raise ValueError(f"missing required features: {missing}")
    return df.select(*features)


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per column, fitted in one aggregation."""

    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Scaling":
        facts = column_facts(df, columns)
        # a constant column is only centred
        deviation = {c: f["std_pop"] or 1.0 for c, f in facts.items()}
        return cls({c: f["mean"] or 0.0 for c, f in facts.items()}, deviation)

    def expression(self, c: str) -> str:
        return f"({c} - {number(self.mean[c])}) / {number(self.deviation[c])}"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.selectExpr(*[f"{self.expression(c)} AS {c}" if c in self.mean else c for c in df.columns])


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with population deviation, in place."""
    return Scaling.fit(df, columns).apply(df)


def chrono_split(df: DataFrame, series: Series = HOURLY, test_share: float = TEST_SHARE) -> DataFrame:
    """Add ``is_test``: the last ceil(share * n) rows of each series in time order."""
    numbered = ordinal(df, series, "__position", "__size")
    return numbered.selectExpr(*df.columns, f"__position >= __size - ceil({test_share}D * __size) AS is_test")


def fold_number(position: str, size: str, scheme: str = "time_series") -> str:
    """Validation fold (1..3) of a row.

    ``time_series``: consecutive tail folds of size n div 4, each validated against everything before
    it; fold 0 only trains. ``contiguous``: three contiguous folds, the first n mod 3 one row longer.
    """
    n_fold = f"greatest({size} div {FOLDS + 1}, 1)"
    tail = f"greatest(({position} - ({size} - {FOLDS} * {n_fold})), -1)"
    time_series = f"CASE WHEN {tail} < 0 THEN 0 ELSE {tail} div {n_fold} + 1 END"
    long = f"({size} div {FOLDS} + 1)"
    longer_rows = f"({size} % {FOLDS}) * {long}"
    contiguous = (
        f"CASE WHEN {position} < {longer_rows} THEN {position} div {long} + 1"
        f" ELSE ({position} - {longer_rows}) div greatest({size} div {FOLDS}, 1) + {size} % {FOLDS} + 1 END"
    )
    if scheme not in ("time_series", "contiguous"):
        raise ValueError(f"unknown fold scheme {scheme}")
    return time_series if scheme == "time_series" else contiguous


def cv_folds(df: DataFrame, series: Series = HOURLY, scheme: str = "time_series") -> DataFrame:
    """Add ``fold`` and ``past_only`` (validated against earlier folds only) per series."""
    numbered = ordinal(df, series, "__position", "__size")
    fold = f"CAST({fold_number('__position', '__size', scheme)} AS INT) AS fold"
    return numbered.selectExpr(*df.columns, fold, f"{str(scheme == 'time_series').lower()} AS past_only")


def scoring_stages(scaling: Scaling, features: Sequence[str]) -> list:
    """Scaler and assembler as storable stages: column order and scaling travel with the model."""
    scaled = ", ".join(f"{scaling.expression(c)} AS __z{i}" for i, c in enumerate(features))
    scaler = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    return [scaler, VectorAssembler(inputCols=[f"__z{i}" for i in range(len(features))], outputCol="features")]


def assemble(df: DataFrame, stages: list, label: str = TARGET) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df.withColumn("label", F.col(label).cast("double"))


def make_estimator(name: str, rows: int, label_deviation: float):
    """Estimator with the fixed parameters; ridge weights its penalty so that it equals the closed form."""
    if name == "random_forest":
        return RandomForestRegressor(**FOREST)
    if name == "gradient_boosting":
        return GBTRegressor(**BOOSTING)
    if name == "ridge":
        penalty = RIDGE_ALPHA * label_deviation / max(rows, 1)
        return LinearRegression(elasticNetParam=0.0, standardization=False, solver="normal", regParam=penalty)
    raise ValueError(f"unknown model {name}")


def fixed_layout(rows: DataFrame, series: Series = HOURLY, partitions: int | None = None) -> DataFrame:
    """Rows in an order that depends on the data only: bagging follows partitions and places within them.

    The number of partitions is part of the result for tree models. Unless given it follows from the rows:
    one for every ``PARTITION_ROWS``, ``LEAST_PARTITIONS`` at least.
    """
    order = [*series.keys, series.time]
    partitions = partitions or max(LEAST_PARTITIONS, -(-rows.count() // PARTITION_ROWS))
    return rows.repartition(partitions, *order).sortWithinPartitions(*order)


def fit_model(name: str, assembled: DataFrame):
    n, deviation = assembled.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    if n < FOLDS:
        raise ValueError(f"{n} rows are too few to train on")
    if n < 10:
        log.warning("only %d rows to train on", n)
    return make_estimator(name, n, deviation or 1.0).fit(assembled)


@dataclass
class Training:
    """What a training run leaves: storable models, their metrics and the rows they were fitted on."""

    models: dict[str, PipelineModel]
    metrics: DataFrame
    features: list[str]
    assembled: DataFrame

    @property
    def best(self) -> str | None:
        row = self.metrics.where("is_best").first()
        return row["model"] if row else None


def train_models(
    df: DataFrame,
    series: Series = HOURLY,
    names: Sequence[str] = MODELS,
    exclude_target: bool = False,
    cross_validate: bool = False,
    partitions: int | None = None,
) -> Training:
    """Impute, scale on all rows, split in time order, fit every model and mark the best test error.

    A model that cannot be fitted is reported and skipped. The assembled rows are written once.
    """
    features = select_features(df, exclude_target)
    prepared = median_impute(df, features)
    stages = scoring_stages(Scaling.fit(prepared, features), features)
    split = assemble(chrono_split(prepared, series), stages)
    rows = materialize(split.select(*series.keys, series.time, "features", "label", "is_test"), "training")
    train = fixed_layout(rows.where("NOT is_test"), series, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    models, reports = {}, None
    for position, name in enumerate(names):
        try:
            model = fit_model(name, train)
            scored = model.transform(rows)
            report = _report(name, position, scored)
            if cross_validate:
                summary = cross_validation(name, train, series).first()
                report = report.withColumns({k: F.lit(v) for k, v in summary.asDict().items()})
        except (ValueError, AnalysisException, IllegalArgumentException) as error:  # one model must not stop the others
            log.warning("training %s failed: %s", name, error)
            continue
        models[name] = PipelineModel(stages=[*stages, model])
        reports = report if reports is None else reports.unionByName(report)
    train.unpersist()
    if reports is None:
        raise RuntimeError("no model could be trained")
    return Training(models, best_model(reports), features, rows)


def _report(name: str, position: int, scored: DataFrame) -> DataFrame:
    """One row of train and test metrics."""
    by_split = evaluate_split(scored, ["is_test"], "label", "prediction")
    picks = [
        F.max(F.when(F.col("is_test") == (part == "test"), F.col(m))).alias(f"{part}_{m}")
        for m in ("rmse", "mae", "r2", "mape")
        for part in ("train", "test")
    ]
    one = by_split.agg(*picks)
    return one.select(F.lit(name).alias("model"), F.lit(position).alias("training_order"), "*")


def cross_validation(name: str, train: DataFrame, series: Series = HOURLY) -> DataFrame:
    """Score every fold; returns the one-row summary. A ridge is solved from sums per fold, other models are fitted fold by fold."""
    folds = cv_folds(train, series)
    if name == "ridge":
        width = len(train.select("features").first()[0])
        values = F.array_append(vector_to_array("features"), F.col("label"))
        scores = ridge_cv_values(folds, values, width + 1, alpha=RIDGE_ALPHA).select("fold", "mse")
        if scores.isEmpty():
            raise ValueError("too few rows for cross-validation")
        return cv_summary(scores)
    folded = materialize(folds, "folds")
    scores = None
    for fold in range(1, FOLDS + 1):
        fit_on = folded.where(f"CASE WHEN past_only THEN fold < {fold} ELSE fold <> {fold} END")
        held_out = folded.where(f"fold = {fold}")
        if fit_on.isEmpty() or held_out.isEmpty():
            continue
        score = cv_scores(fit_model(name, fit_on).transform(held_out), "label", "prediction")
        scores = score if scores is None else scores.unionByName(score)
    if scores is None:
        raise ValueError("too few rows for cross-validation")
    return cv_summary(scores)


def feature_importance(model: PipelineModel, features: Sequence[str], df: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per feature, largest first; only tree models have it."""
    weights = model.stages[-1].featureImportances.toArray()
    table = df.sparkSession.createDataFrame(
        [(c, float(w)) for c, w in zip(features, weights)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
    return table.limit(top) if top else table


def save_run(run: Training, base: str, run_ts: str, df: DataFrame) -> DataFrame:
    """Store every model of a run under ``<base>/<run_ts>_<model>`` and record it in ``<base>/runs``; returns the records.

    ``df`` only lends its session.
    """
    base = base.rstrip("/")
    rows = []
    for name, model in run.models.items():
        path = f"{base}/{run_ts}_{name}"
        model.write().save(path)
        rows.append((run_ts, f"{run_ts}_{name}", path, run.features, name == run.best))
    records = df.sparkSession.createDataFrame(rows, RUNS_SCHEMA)
    records.write.mode("append").parquet(f"{base}/runs")
    return records


def load_model(spark, base: str, model_type: str | None = None, run_ts: str | None = None) -> tuple[PipelineModel, str, list[str]]:
    """(model, type, features) of a stored run: the newest one unless named, its best model unless a type is asked for."""
    runs = spark.read.schema(RUNS_SCHEMA).parquet(f"{base.rstrip('/')}/runs").withColumn("model_type", F.expr(MODEL_TYPE))
    wanted = runs.where("is_best") if model_type is None else runs.where(F.col("model_type") == model_type)
    if run_ts is not None:
        wanted = wanted.where(F.col("run_ts") == run_ts)
    found = wanted.orderBy(F.desc("run_ts")).first()
    if found is None:
        raise ValueError(f"no stored model of type {model_type or 'any'} and run {run_ts or 'any'}")
    return PipelineModel.load(found["path"]), found["model_type"], found["features"]


def model_types(spark, base: str) -> DataFrame:
    """Distinct model types among the stored runs."""
    return spark.read.schema(RUNS_SCHEMA).parquet(f"{base.rstrip('/')}/runs").selectExpr(f"{MODEL_TYPE} AS model_type").distinct()


def predict_single(model: PipelineModel, df: DataFrame, model_type: str, at: str | None = None, series: Series = HOURLY) -> DataFrame:
    """Prediction for one instant, or for the newest row of every series, with its change against the current price."""
    rows = latest_row(df, series) if at is None else at_time(df, at, series.time)
    return predict_batch(model, rows, model_type, series, fill=False)


def score_row(
    model: PipelineModel, df: DataFrame, model_type: str, bounds: dict, features: Sequence[str], row: str = "latest", series: Series = HOURLY
) -> DataFrame:
    """Drift ratio and prediction of one row per series: the latest, or the first of the given rows."""
    if row not in ("latest", "first"):
        raise ValueError(f"unknown row choice {row}")
    rows = latest_row(df, series) if row == "latest" else first_row(df, series)
    scored = predict_batch(model, rows, model_type, series, fill=False)
    ratios = drift_ratio(rows, bounds, features).select(*series.keys, series.time, "drift_ratio")
    return scored.join(ratios, [*series.keys, series.time])


def predict_job(model: PipelineModel, df: DataFrame, model_type: str, path: str, series: Series = HOURLY, **options) -> DataFrame:
    """Batch predictions stored under ``path``, and their evaluation per series against the price."""
    predict_batch(model, df, model_type, series, **options).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return evaluate_forecast(stored, "current_price", "predicted_price", by=list(series.keys))


def predict_batch(
    model: PipelineModel,
    df: DataFrame,
    model_type: str,
    series: Series = HOURLY,
    start: str | None = None,
    end: str | None = None,
    fill: bool = True,
) -> DataFrame:
    """Predictions for a closed time range next to the current price. ``fill`` closes feature gaps first."""
    rows = time_range(df, series.time, start, end)
    if fill:
        rows = ffill_bfill(rows, numeric_columns(rows), series)
    scored = model.transform(rows).withColumnRenamed("prediction", "predicted_price")
    change = "predicted_price - price"
    return scored.selectExpr(
        *series.keys,
        series.time,
        "predicted_price",
        f"'{model_type}' AS model_type",
        "price AS current_price",
        f"{change} AS predicted_change",
        f"{ieee_div(change, 'price')} * 100 AS predicted_change_pct",
    )


def line_slopes(model: PipelineModel) -> dict[str, float] | None:
    """What one unit of every column adds to the prediction of a linear model; None for other models."""
    line = model.stages[-1]
    if not isinstance(line, LinearRegressionModel):
        return None
    scaled = re.findall(r"\((\w+) - \S+\) / (\S+)D AS __z(\d+)", model.stages[0].getStatement())
    return {c: float(line.coefficients[int(i)]) / float(deviation) for c, deviation, i in scaled}


def predict_future(
    model: PipelineModel, df: DataFrame, hours: int, model_type: str, series: Series = HOURLY, cut_every: int = 6
) -> DataFrame:
    """Recursive forecast of one hour or more for every series at once.

    Each step predicts from the newest row per series, moves it one hour on, sets the predicted price
    and the two one-hour changes, and leaves every other feature as it is. For a linear model everything that does not
    move is one number per series, and all steps are one fold over an array. Other models are a chain of steps, cut by a
    written table every few hours, in which the path so far rides along in an array.
    """
    if hours < 1:
        raise ValueError("hours must be at least 1")
    slopes = line_slopes(model)
    if slopes is not None:
        ahead = _folded_path(model, latest_row(df, series), hours, slopes, series)
    else:
        ahead = _chained_path(model, latest_row(df, series), hours, series, cut_every)
    rows = ahead.selectExpr(*series.keys, "__now", "posexplode(__path) AS (__hour, __price)")
    return rows.selectExpr(
        *series.keys,
        f"__now + (__hour + 1) * INTERVAL 1 HOUR AS {series.time}",
        "__price AS predicted_price",
        "__hour + 1 AS hours_ahead",
        f"'{model_type}' AS model_type",
    )


def _folded_path(model: PipelineModel, frontier: DataFrame, hours: int, slopes: dict[str, float], series: Series) -> DataFrame:
    """keys, __now, __path: the state of the fold is the three columns that move and the prices so far."""
    moving = {c: f for c, f in ((TARGET, "price"), ("price_change_1h", "change"), ("price_pct_change_1h", "share")) if c in slopes}
    start = model.transform(frontier)
    still = " - ".join(["prediction", *[f"{number(slopes[c])} * {c}" for c in moving]])
    rows = start.selectExpr(*series.keys, f"{series.time} AS __now", f"{still} AS __still", f"CAST({TARGET} AS DOUBLE) AS __price", *[c for c in moving if c != TARGET])
    first = ", ".join(f"'{f}', CAST({c if c in moving else 'NULL'} AS DOUBLE)" for c, f in (("price_change_1h", "change"), ("price_pct_change_1h", "share")))
    state = f"named_struct('price', __price, {first}, 'path', CAST(array() AS array<double>))"
    price = " + ".join(["__still", *[f"{number(slopes[c])} * s.{f}" for c, f in moving.items()]])
    step = f"p -> named_struct('price', p, 'change', p - s.price, 'share', {ieee_div('p - s.price', 's.price')}, 'path', concat(s.path, array(p)))"
    fold = f"aggregate(sequence(1, {hours}), {state}, (s, h) -> transform(array({price}), {step})[0], s -> s.path)"
    return rows.selectExpr(*series.keys, "__now", f"{fold} AS __path")


def _chained_path(model: PipelineModel, frontier: DataFrame, hours: int, series: Series, cut_every: int) -> DataFrame:
    """keys, __now, __path for any model."""
    frontier = materialize(frontier, "frontier")
    columns = frontier.columns
    ahead = frontier.selectExpr("*", f"{series.time} AS __now", "CAST(array() AS array<double>) AS __path")
    moves = {
        series.time: f"{series.time} + INTERVAL 1 HOUR",
        TARGET: "prediction",
        "price_change_1h": f"prediction - {TARGET}",
        "price_pct_change_1h": ieee_div(f"prediction - {TARGET}", TARGET),
    }
    step = [f"{moves[c]} AS {c}" if c in moves else c for c in columns]
    for hour in range(1, hours + 1):
        ahead = model.transform(ahead).selectExpr(*step, "__now", "concat(__path, array(prediction)) AS __path")
        if hour % cut_every == 0 and hour < hours:
            ahead = materialize(ahead, "frontier")
    return ahead
