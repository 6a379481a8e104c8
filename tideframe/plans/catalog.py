"""Every operator as a named query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions.numeric import numeric_columns, round_doubles
from tideframe.operators import clean, drift, evaluate, features, gram, learn, profile, publish, quality, requests
from tideframe.plans.adaptive import PATH, cut_full_buckets
from tideframe.plans.ordered import EVENT_LOG, HOURLY, Series, forward_fill, ordinal, previous, running_total
from tideframe.session import materialize, new_path
from tideframe.sources import files
from tideframe.sources.tables import (
    BASE_COLUMNS,
    events,
    market_dirty,
    market_hourly,
    naive_predictions,
    request_log,
    table,
)
from tideframe.streaming import alerts as stream_alerts
from tideframe.streaming import ingest, metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-31 00:00:00"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20 12:00:00"


def query(build: Query) -> Query:
    """Register a query under its function name; doubles are rounded for comparison across engines."""
    QUERIES[build.__name__] = lambda spark, folder: round_doubles(build(spark, folder))
    return build


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return market_hourly(events(spark, folder))


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    return market_dirty(hourly(spark, folder))


def log(spark: SparkSession, folder: str) -> DataFrame:
    return request_log(events(spark, folder))


def compact(spark: SparkSession, folder: str) -> DataFrame:
    """The compact feature set of the hourly series, kept because several passes read it."""
    rows = features.compact_features(hourly(spark, folder), order=None)
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


# sources and sinks ---------------------------------------------------------------------------


@query
def market_chart_flatten(spark, folder):
    path = new_path(spark, "payload")
    files.to_market_chart(hourly(spark, folder)).write.json(path)
    return files.flatten_market_chart(files.require_prices(files.read_market_chart(spark, path)))


@query
def csv_roundtrip(spark, folder):
    rows = hourly(spark, folder).select("timestamp", *BASE_COLUMNS, "coin_id")
    path = publish.write_csv(rows, new_path(spark, "csv"))
    return files.read_series_csv(spark, path, f"{files.SERIES_SCHEMA}, coin_id string")


@query
def latest_version(spark, folder):
    base, rows = new_path(spark, "versions"), hourly(spark, folder)
    for day in ("2024-01-10", "2024-01-20", "2024-01-30"):
        rows.where(F.col("timestamp") < F.lit(day).cast("timestamp")).write.parquet(f"{base}/processed_{day}")
    return files.latest_version(spark, base)


@query
def content_manifest(spark, folder):
    """The files of the event table."""
    return publish.content_manifest(spark.read.parquet(f"{folder}/events.parquet"))


@query
def table_fingerprint(spark, folder):
    return publish.table_fingerprint(events(spark, folder))


@query
def publish_verify(spark, folder):
    """The record of a published copy; its digest is checked against the source, its text depends on the engine."""
    return publish.publish_dataset(hourly(spark, folder), new_path(spark, "published"), "hourly", "20240131_000000").drop("digest")


# filters and lookups -------------------------------------------------------------------------


@query
def time_range_filter(spark, folder):
    return publish.time_range(hourly(spark, folder), "timestamp", RANGE_START, RANGE_END)


@query
def latest_row(spark, folder):
    return publish.latest_row(hourly(spark, folder))


@query
def first_row(spark, folder):
    return publish.first_row(hourly(spark, folder))


@query
def dropna_rows(spark, folder):
    return clean.drop_missing(dirty(spark, folder))


# cleaning and imputation -----------------------------------------------------------------------


@query
def dedupe_first(spark, folder):
    return clean.dedupe_first(dirty(spark, folder))


@query
def ffill(spark, folder):
    return clean.ffill(clean.dedupe_first(dirty(spark, folder)))


@query
def ffill_bfill(spark, folder):
    return clean.ffill_bfill(clean.dedupe_first(dirty(spark, folder)))


@query
def clean_series(spark, folder):
    return clean.clean_series(dirty(spark, folder))


@query
def clean_series_strict(spark, folder):
    return clean.clean_series_strict(dirty(spark, folder))


@query
def median_impute(spark, folder):
    broken = dirty(spark, folder).withColumn(
        "price", F.expr("CASE WHEN hour(timestamp) = 3 THEN double('Infinity') ELSE price END")
    )
    return clean.median_impute(broken, BASE_COLUMNS)


# features --------------------------------------------------------------------------------------


@query
def temporal_features(spark, folder):
    return features.add_temporal_features(hourly(spark, folder))


@query
def lag_features(spark, folder):
    return features.add_lag_features(hourly(spark, folder))


@query
def rolling_features(spark, folder):
    return features.add_rolling_features(hourly(spark, folder))


@query
def price_change_features(spark, folder):
    return features.add_price_change_features(hourly(spark, folder))


@query
def volume_features(spark, folder):
    return features.add_volume_features(hourly(spark, folder))


@query
def technical_indicators(spark, folder):
    return features.add_technical_indicators(hourly(spark, folder))


@query
def ewma_features(spark, folder):
    return features.add_ewma_features(clean.dedupe_first(dirty(spark, folder)).drop("ingest_seq"))


@query
def features_full(spark, folder):
    return features.full_features(dirty(spark, folder))


@query
def features_compact(spark, folder):
    return features.compact_features(dirty(spark, folder))


@query
def feature_select(spark, folder):
    rows = features.add_temporal_features(hourly(spark, folder))
    return rows.select("coin_id", "timestamp", *learn.select_features(rows))


# quality ---------------------------------------------------------------------------------------


@query
def null_check(spark, folder):
    return quality.null_check(dirty(spark, folder))


@query
def schema_check(spark, folder):
    return quality.schema_check(hourly(spark, folder).drop("market_cap"))


@query
def type_check(spark, folder):
    raw = hourly(spark, folder).selectExpr(
        "date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') AS timestamp",
        "CASE WHEN hour(timestamp) = 5 THEN 'n/a' ELSE CAST(price AS STRING) END AS price",
        "CAST(market_cap AS STRING) AS market_cap",
        "total_volume",
    )
    return quality.type_check(raw)


@query
def range_check(spark, folder):
    return quality.range_check(hourly(spark, folder))


@query
def freshness_check(spark, folder):
    return quality.freshness_check(hourly(spark, folder), as_of=AS_OF)


@query
def completeness_check(spark, folder):
    return quality.completeness_check(hourly(spark, folder))


@query
def quality_report(spark, folder):
    return quality.quality_report(clean.dedupe_first(dirty(spark, folder)).drop("ingest_seq"), as_of=AS_OF)


@query
def quality_gate(spark, folder):
    return quality.quality_gate(dirty(spark, folder))


# profiles --------------------------------------------------------------------------------------


def _deliveries(spark, folder):
    return dirty(spark, folder).drop("ingest_seq")


@query
def describe_stats(spark, folder):
    return profile.describe_stats(_deliveries(spark, folder))


@query
def profile_summary(spark, folder):
    return profile.profile_summary(_deliveries(spark, folder))


@query
def quality_score(spark, folder):
    return profile.profile_summary(_deliveries(spark, folder)).select("data_quality_score")


@query
def missing_by_column(spark, folder):
    return profile.missing_by_column(_deliveries(spark, folder))


@query
def duplicate_rows(spark, folder):
    return profile.top_duplicates(_deliveries(spark, folder))


@query
def correlation_matrix(spark, folder):
    return profile.correlation_matrix(hourly(spark, folder), BASE_COLUMNS)


@query
def sample_rows(spark, folder):
    """First and last rows; the random part depends on the engine's hash and is tested on its own."""
    return profile.sample_rows(hourly(spark, folder), ["timestamp", "coin_id"], random=False)


# drift -----------------------------------------------------------------------------------------


def _parts(spark, folder):
    """First 80 % of every series to learn the bounds from, the rest to score."""
    rows = materialize(learn.chrono_split(compact(spark, folder)), "split")
    return rows.where("NOT is_test").drop("is_test"), rows.where("is_test").drop("is_test")


def _bounds(train):
    return drift.observed_bounds(train)


@query
def training_stats(spark, folder):
    return drift.training_stats(_parts(spark, folder)[0])


@query
def drift_bounds(spark, folder):
    return _bounds(_parts(spark, folder)[0])


@query
def drift_flags(spark, folder):
    train, rest = _parts(spark, folder)
    return drift.drift_flags(rest, _bounds(train), numeric_columns(rest), ["coin_id", "timestamp"])


def _ratios(spark, folder):
    train, rest = _parts(spark, folder)
    return drift.drift_ratio(rest, drift.collect_bounds(_bounds(train)), numeric_columns(rest))


@query
def drift_ratio(spark, folder):
    return _ratios(spark, folder).select("coin_id", "timestamp", "drift_ratio")


@query
def drift_detections(spark, folder):
    train, rest = _parts(spark, folder)
    flags = drift.drift_flags(rest, _bounds(train), numeric_columns(rest), ["coin_id", "timestamp"])
    return drift.drift_detections(flags.withColumnRenamed("coin_id", "model_type"))


@query
def drift_alert(spark, folder):
    return requests.drift_alert(_ratios(spark, folder).select("coin_id", "timestamp", "drift_ratio"), HOURLY, 0.05)


# learning and evaluation -----------------------------------------------------------------------


@query
def standard_scale(spark, folder):
    return learn.standard_scale(hourly(spark, folder), BASE_COLUMNS)


@query
def chrono_split(spark, folder):
    return learn.chrono_split(hourly(spark, folder))


@query
def ts_cv_folds(spark, folder):
    return learn.cv_folds(hourly(spark, folder))


@query
def contiguous_cv_folds(spark, folder):
    return learn.cv_folds(hourly(spark, folder), scheme="contiguous")


def _gappy_log(spark, folder):
    """Events of which some have no type, some no time, and a long stretch of each type no value."""
    return events(spark, folder).selectExpr(
        "event_id",
        "CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind",
        "CASE WHEN event_id % 11 <> 0 THEN ts END AS ts",
        "CASE WHEN event_id % 5 <> 0 THEN value END AS value",
    )


@query
def ordered_null_keys(spark, folder):
    """Row number, running count, row before and fill over series of which one has no key and rows without a time."""
    series = Series(("kind",), "ts", ("event_id",), "day")
    rows = previous(_gappy_log(spark, folder), series, ["event_id"])
    rows = ordinal(running_total(rows, series, "1L", "counter"), series, "position", "size")
    return forward_fill(rows, series, ["value"]).drop("ts")


@query
def ewma_long_gaps(spark, folder):
    """Exponential means of short and long spans over events whose values are missing for most of January."""
    rows = events(spark, folder).selectExpr(
        "event_id", "event_type", "ts", "CASE WHEN ts < TIMESTAMP '2024-01-03' OR ts > TIMESTAMP '2024-01-25' THEN value END AS value"
    )
    series = Series(("event_type",), "ts", ("event_id",), "day")
    out = features.add_ewma_features(rows, series, "value", (6, 24, 200))
    return out.select("event_id", *[f"value_ewma_{n}h" for n in (6, 24, 200)])


@query
def evaluate_forecast(spark, folder):
    return evaluate.evaluate_forecast(naive_predictions(hourly(spark, folder)), by=["coin_id"])


@query
def directional_accuracy(spark, folder):
    return evaluate.directional_accuracy(naive_predictions(hourly(spark, folder)))


@query
def evaluate_train_test(spark, folder):
    return evaluate.evaluate_split(learn.chrono_split(naive_predictions(hourly(spark, folder))), ["is_test"])


@query
def cv_summary(spark, folder):
    return evaluate.cv_summary(evaluate.cv_scores(learn.cv_folds(naive_predictions(hourly(spark, folder)))))


@query
def model_gate(spark, folder):
    """The naive forecast against one that repeats the series mean of the last six hours."""
    rows = features.add_rolling_features(hourly(spark, folder), columns=["price"], windows=[6])
    rows = features.previous_row(rows, ["price", "price_rolling_mean_6h"])
    both = rows.dropna("any", subset=["prev_price_rolling_mean_6h"]).withColumn("actual", F.col("price"))
    names = ["rmse", "mae", "r2"]

    def score(predicted):
        return evaluate.metrics_long(evaluate.evaluate_forecast(both, "actual", predicted), names)

    return evaluate.model_gate(score("prev_price"), score("prev_price_rolling_mean_6h"))


def _train(spark, folder, *names):
    return learn.train_models(compact(spark, folder), names=names)


def _training_report(spark, folder, name):
    return _train(spark, folder, name).metrics


@query
def train_ridge(spark, folder):
    return _training_report(spark, folder, "ridge")


@query
def train_random_forest(spark, folder):
    return _training_report(spark, folder, "random_forest")


@query
def train_gbt(spark, folder):
    return _training_report(spark, folder, "gradient_boosting")


@query
def feature_importance(spark, folder):
    run = _train(spark, folder, "random_forest")
    return learn.feature_importance(run.models["random_forest"], run.features, run.assembled, top=15)


@query
def best_model(spark, folder):
    return learn.train_models(compact(spark, folder)).metrics


@query
def forecast_batch(spark, folder):
    rows = compact(spark, folder)
    run = learn.train_models(rows, names=["ridge"])
    return learn.predict_batch(run.models["ridge"], rows, "ridge", start=RANGE_START, end=RANGE_END)


@query
def forecast_recursive(spark, folder):
    rows = compact(spark, folder)
    run = learn.train_models(rows, names=["ridge"])
    return learn.predict_future(run.models["ridge"], rows, 24, "ridge")


def _two_features(spark, folder):
    """A ridge over two features of the hourly series, whose closed form SQL can solve, and its rows."""
    rows = hourly(spark, folder)
    return learn.train_models(rows, names=["ridge"], exclude_target=True), rows


def _four_digits(rows):
    """Solvers of two engines agree to about ten digits of the result."""
    return rows.select(*[F.round(c, 4).alias(c) if t == "double" else c for c, t in rows.dtypes])


@query
def ridge_two_features(spark, folder):
    run, _ = _two_features(spark, folder)
    return _four_digits(run.metrics.select("model", "train_rmse", "test_rmse", "train_mae", "test_mae", "is_best"))


_PAIR = ["market_cap", "total_volume"]


@query
def ridge_cv(spark, folder):
    """Every fold of a ridge over two scaled features, from one pass of sums over the training part."""
    rows = learn.chrono_split(learn.standard_scale(hourly(spark, folder), _PAIR)).where("NOT is_test")
    scores = gram.ridge_cv(learn.cv_folds(rows), _PAIR)
    return _four_digits(scores.selectExpr("fold", "train_rows", "valid_rows", "sqrt(mse) AS rmse"))


@query
def ridge_per_series(spark, folder):
    """One ridge per series from one pass of sums over the training parts, and its errors on either part."""
    rows = learn.chrono_split(hourly(spark, folder)).persist(StorageLevel.MEMORY_AND_DISK)
    models = gram.ridge_per_group(rows.where("NOT is_test"), _PAIR, ["coin_id"])
    scored = evaluate.evaluate_split(gram.predict_per_group(rows, models, _PAIR, ["coin_id"]), ["coin_id", "is_test"], "price")
    return _four_digits(scored.select("coin_id", "is_test", "rmse", "mae", "sample_count"))


@query
def forecast_linear(spark, folder):
    """Recursive forecast of a ridge over the price and its last change, both of which move."""
    rows = features.previous_row(hourly(spark, folder), ["price"]).where("prev_price IS NOT NULL")
    rows = rows.selectExpr("coin_id", "timestamp", "price", "price - prev_price AS price_change_1h")
    run = learn.train_models(rows, names=["ridge"])
    return _four_digits(learn.predict_future(run.models["ridge"], rows, 24, "ridge"))


@query
def predict_single(spark, folder):
    run, rows = _two_features(spark, folder)
    return _four_digits(learn.predict_single(run.models["ridge"], rows, "ridge"))


@query
def scoring_pipeline(spark, folder):
    """Drift against the training part and prediction of the newest row of every series."""
    run, rows = _two_features(spark, folder)
    names = ["market_cap", "total_volume"]
    past = learn.chrono_split(rows).where("NOT is_test")
    bounds = drift.collect_bounds(drift.drift_bounds(drift.training_stats(past, names)))
    return _four_digits(learn.score_row(run.models["ridge"], rows, "ridge", bounds, names))


@query
def predict_job(spark, folder):
    """Stored run, loaded again by its type, predictions stored and evaluated per series."""
    run, rows = _two_features(spark, folder)
    base = new_path(spark, "runs")
    learn.save_run(run, base, "20240131_000000", rows)
    model, kind, _ = learn.load_model(spark, base)
    return _four_digits(learn.predict_job(model, rows, kind, new_path(spark, "predictions")).select("coin_id", "rmse", "mae", "sample_count"))


@query
def run_summary(spark, folder):
    raw = hourly(spark, folder)
    gate = quality.quality_gate(raw).agg(
        F.expr("CAST(max(CASE WHEN check_name = 'rows' THEN value END) AS BIGINT) AS total_rows"),
        F.expr("bool_and(passed) AS quality_passed"),
    )
    rows = compact(spark, folder)
    published = publish.publish_dataset(rows, new_path(spark, "published"), "features", "20240131_000000")
    trained = learn.train_models(rows, names=["ridge"]).metrics
    return publish.run_summary(gate, profile.profile_summary(rows), published, trained)


# requests, rates and alerts ----------------------------------------------------------------------


@query
def request_counts(spark, folder):
    return requests.request_counts(log(spark, folder), ["endpoint", "status", "model_type"])


@query
def endpoint_summary(spark, folder):
    return requests.endpoint_summary(log(spark, folder))


@query
def prediction_metrics(spark, folder):
    return requests.prediction_metrics(log(spark, folder))


@query
def latency_histogram(spark, folder):
    return requests.latency_histogram(log(spark, folder))


@query
def request_counts_by_method(spark, folder):
    """Counter with all three labels; the status follows from the response code."""
    return requests.request_counts(requests.with_status(log(spark, folder)), ["method", "endpoint", "status"])


@query
def counter_rate_filled(spark, folder):
    """Rates with zeros where a counter stands still."""
    ranges = requests.over_ranges(log(spark, folder), ["endpoint", "status"], {"n": "count(1)"})
    filled = requests.fill_ranges(ranges, ["endpoint", "status"], ["n"])
    return filled.selectExpr("endpoint", "status", "window_end", "n / 300D AS rate")


@query
def prediction_histogram(spark, folder):
    return requests.latency_histogram(log(spark, folder), ["model_type"], buckets=requests.PREDICTION_BUCKETS)


@query
def active_requests(spark, folder):
    return requests.active_requests(log(spark, folder))


@query
def counter_series(spark, folder):
    return requests.counter_series(log(spark, folder))


@query
def counter_rate(spark, folder):
    return requests.counter_rate(log(spark, folder))


SAMPLES = Series(keys=("endpoint",), time="ts", fine="day")


@query
def sampled_counter_rate(spark, folder):
    return requests.sampled_rate(requests.scrape_counter(log(spark, folder)), SAMPLES)


@query
def increase_by_status(spark, folder):
    return requests.increase_by_status(log(spark, folder))


@query
def latency_quantiles(spark, folder):
    return requests.latency_quantiles(log(spark, folder))


def _health_of(rows):
    return rows.select("event_id", "ts", "model_type", F.when(F.col("status") == "error", 0).otherwise(1).alias("health"))


def _health(spark, folder):
    return _health_of(log(spark, folder))


@query
def gauge_last(spark, folder):
    return requests.gauge_last(_health(spark, folder), ["model_type"], "health")


@query
def model_health_alert(spark, folder):
    return requests.health_alert(_health(spark, folder), EVENT_LOG.by("model_type"))


def burst(spark, folder):
    """The event table with nine tenths of its rows in one second of one series."""
    in_burst = "pmod(event_id, 10) < 9"
    second = "timestamp_micros(unix_micros(TIMESTAMP '2024-01-15 12:00:00') + pmod(event_id * 7919, 1000) * 1000)"
    return events(spark, folder).selectExpr(
        "event_id", f"CASE WHEN {in_burst} THEN {second} ELSE ts END AS ts", f"CASE WHEN {in_burst} THEN 'view' ELSE event_type END AS endpoint", "CASE WHEN pmod(event_id, 7) < 3 THEN value END AS value"
    )


BURST = EVENT_LOG.by("endpoint")


@query
def burst_running_count(spark, folder):
    """Counter values while one second of one endpoint holds almost all events."""
    rows, series = cut_full_buckets(burst(spark, folder), BURST, 500)
    return running_total(rows, series, "1L", "counter").select("endpoint", "ts", "event_id", "counter")


@query
def burst_forward_fill(spark, folder):
    rows, series = cut_full_buckets(burst(spark, folder), BURST, 500)
    return forward_fill(rows, series, ["value"]).drop(PATH)


@query
def burst_alert(spark, folder):
    """Stretches of high values, which start and end within the burst."""
    rows, series = cut_full_buckets(burst(spark, folder), BURST, 500)
    return requests.sustained(rows, series, "value > 50", 0, "value")


@query
def gauge_on_grid(spark, folder):
    return requests.gauge_on_grid(_health(spark, folder), ["model_type"], "health")


@query
def model_health_alert_on_grid(spark, folder):
    """Unhealthy models as the rule sees them: every 30 seconds, values of the last five minutes only."""
    grid = requests.gauge_on_grid(_health(spark, folder), ["model_type"], "health")
    return requests.grid_alert(grid, ["model_type"], "health = 0", requests.HOLD_SECONDS["ModelUnhealthy"], "health")


@query
def prediction_drift(spark, folder):
    """Every prediction with the drift ratio its model had set last for the series.

    The models take turns: each hour one of them scores the hour before and sets its ratio.
    """
    keys = ("model_type", "coin_id")
    ratios = _ratios(spark, folder).selectExpr("concat('m', hour(timestamp) % 3) AS model_type", "coin_id", "timestamp + INTERVAL 1 HOUR AS ts", "0L AS event_id", "drift_ratio")
    served = log(spark, folder).select("model_type", F.col("endpoint").alias("coin_id"), "ts", "event_id", "latency_s")
    return requests.as_of_join(served, materialize(ratios, "ratios"), Series(keys, "ts", ("event_id",), "day"), ["drift_ratio"])


@query
def alert_for_duration(spark, folder):
    return requests.latency_alert(requests.latency_quantiles(log(spark, folder)))


@query
def alerts(spark, folder):
    served = log(spark, folder)
    return requests.alerts(
        requests.latency_quantiles(served),
        requests.counter_rate(served),
        _ratios(spark, folder).select("coin_id", "timestamp", "drift_ratio"),
        _health(spark, folder),
        HOURLY,
        EVENT_LOG.by("model_type"),
    )


# streams ---------------------------------------------------------------------------------------


def _event_stream(spark, folder):
    # braces make it a pattern, so that the table may be one file or a folder of files
    return metrics.event_stream(spark, f"{folder}/{{events.parquet}}")


def _log_stream(spark, folder):
    return request_log(_event_stream(spark, folder))


@query
def stream_counter_rate(spark, folder):
    return metrics.counter_rate(_log_stream(spark, folder), log(spark, folder))


@query
def stream_latency_quantiles(spark, folder):
    return requests.quantiles_of(metrics.histogram_ranges(_log_stream(spark, folder), log(spark, folder)), ["endpoint"])


@query
def stream_health_alert(spark, folder):
    """Unhealthy models as the rule sees them, from a stream."""
    return stream_alerts.drain(_health_of(_log_stream(spark, folder)), stream_alerts.health_alert, {})


@query
def stream_error_rate_alert(spark, folder):
    """Stretches with two errors or more in five minutes, from a stream."""
    return stream_alerts.drain(_log_stream(spark, folder), lambda rows: stream_alerts.error_rate_alert(rows, 0.005), {"status": "'error'"})


@query
def stream_drift_ratio(spark, folder):
    """Value and user of every event scored against the bounds of the first three weeks."""
    past = events(spark, folder).where("ts < TIMESTAMP '2024-01-22 00:00:00'").select("value", "user_id")
    bounds = drift.collect_bounds(drift.drift_bounds(drift.training_stats(past, ["value", "user_id"])))
    scored = drift.drift_ratio(_event_stream(spark, folder), bounds, ["value", "user_id", "event_id"])
    return metrics.run_to_table(scored.select("event_id", "drift_ratio"))


@query
def incremental_merge(spark, folder):
    """Three overlapping pulls of the same history, from its first to its last hour, ingested in two runs."""
    base, rows = new_path(spark, "pulls"), hourly(spark, folder)
    day = dt.timedelta(days=1)
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    for number, (start, end) in enumerate([(first, first + 14 * day), (first + 4 * day, first + 24 * day), (first + 19 * day, last)]):
        pull = rows.where(F.col("timestamp").between(F.lit(start), F.lit(end)))
        pull = pull.withColumn("price", F.col("price") + number).withColumn("ingest_seq", F.lit(number).cast("bigint"))
        pull.write.mode("append").parquet(f"{base}/landing")
        if number != 1:
            ingest.ingest_pulls(spark, f"{base}/landing", f"{base}/history", f"{base}/state")
    return ingest.merged_history(spark, f"{base}/history")


@query
def incremental_features(spark, folder):
    """Compact features of a series that arrives in three batches, the last of which holds hours from the middle."""
    base, rows = new_path(spark, "growing"), hourly(spark, folder).withColumn("ingest_seq", F.lit(0).cast("bigint"))
    write = ingest.correcting_writer(f"{base}/history", f"{base}/features")
    late = "day(timestamp) BETWEEN 9 AND 11"
    for number, part in enumerate([f"day(timestamp) < 18 AND NOT {late}", f"day(timestamp) >= 18 AND NOT {late}", late]):
        write(rows.where(part), number)
    return spark.read.parquet(f"{base}/features").drop("month", "slot")


@query
def staged_versions(spark, folder):
    """The version that readers see: of two published ones, one of them published twice, the newer; a third was never finished."""
    base, rows = new_path(spark, "staged"), hourly(spark, folder)
    for version, end in (("20240110", "2024-01-10"), ("20240131", "2024-02-01"), ("20240110", "2024-01-10")):
        publish.publish_version(rows.where(F.col("timestamp") < F.lit(end).cast("timestamp")), base, "hourly", version)
    publish.stage_version(rows, base, "hourly", "20240201")
    return publish.read_version(spark, base, "hourly").withColumn("version", F.lit(publish.newest_version(spark, base, "hourly")))
