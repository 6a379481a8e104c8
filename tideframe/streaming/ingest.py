"""Repeated pulls of overlapping history, and features that follow a growing series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.functions.numeric import null_safe_doubles
from tideframe.operators.clean import clean_series_strict, dedupe_first
from tideframe.operators.features import compact_features
from tideframe.plans.blocks import SEGMENT_ROWS
from tideframe.plans.ordered import HOURLY, Series, ordinal
from tideframe.session import materialize
from tideframe.sources.tables import BASE_COLUMNS
from tideframe.streaming.metrics import append_to

PULL_SCHEMA = "coin_id string, timestamp timestamp, price double, market_cap double, total_volume double, ingest_seq bigint"


def ingest_pulls(spark: SparkSession, landing: str, history: str, checkpoint: str) -> None:
    """Append every pull that has arrived since the last run to the history, each exactly once."""
    pulls = spark.readStream.schema(PULL_SCHEMA).parquet(landing)
    append_to(pulls, history, checkpoint).awaitTermination()


def merged_history(spark: SparkSession, history: str, series: Series = HOURLY) -> DataFrame:
    """One row per series and hour over all pulls: the first delivery wins."""
    rows = spark.read.schema(PULL_SCHEMA).parquet(history)
    return dedupe_first(rows, series, "ingest_seq").drop("ingest_seq")


def affected_places(rows: DataFrame, changed: str, series: Series = HOURLY, reach: int = SEGMENT_ROWS) -> DataFrame:
    """The rows whose features a changed row can move, with ``__again``, and the ``reach`` rows before them, without.

    Positions are cut into blocks of ``reach`` rows. A changed row can move its own block and the next one, and features
    there read no further back than the block before it. A row stands in for three blocks at most, so what is joined
    grows with the changed rows and not with the series.
    """
    keys = ", ".join(series.keys)
    placed = ordinal(rows, series, "__position").selectExpr("*", f"__position div {reach} AS __block")
    near = placed.where(changed).selectExpr(*series.keys, "__block AS __from").distinct()
    near = near.selectExpr(*series.keys, "__from", "explode(array(-1L, 0L, 1L)) AS __step")
    touched = near.selectExpr(f"struct({keys}, __from + __step AS block) AS __place", "__step >= 0 AS __again")
    touched = touched.groupBy("__place").agg(F.bool_or("__again").alias("__again"))
    placed = placed.withColumn("__place", F.expr(f"struct({keys}, __block AS block)"))
    return placed.join(touched, "__place").select(*rows.columns, "__again")


def corrected_features(rows: DataFrame, changed: str, series: Series = HOURLY, order: str = "ingest_seq") -> tuple[DataFrame, DataFrame]:
    """(keys and time of all rows whose features may have changed, their compact features).

    ``rows`` is the whole history with the new rows, whenever they are from; ``changed`` is a condition that the new ones
    meet. Incomplete rows go and the first delivery wins before anything is numbered, so a new row that loses to an earlier
    delivery changes nothing. What lies more than ``SEGMENT_ROWS`` rows back weighs less than 1e-18 in every feature.
    """
    marked = rows.selectExpr(*series.keys, series.time, *BASE_COLUMNS, order, f"{changed} AS __changed")
    kept = materialize(clean_series_strict(null_safe_doubles(marked), series, order), "history")
    again = materialize(affected_places(kept, "__changed", series), "affected")
    made = compact_features(again.drop("__changed", order), series, None, keep=["__again"]).where("__again").drop("__again")
    return again.where("__again").select(*series.keys, series.time), made


def _part(series: Series, slots: int) -> list[str]:
    """Month and slot of the key: what a correction replaces as a whole."""
    return [f"coalesce(date_format({series.time}, 'yyyy-MM'), 'none') AS month", f"pmod(xxhash64({', '.join(series.keys)}), {slots}) AS slot"]


def replace_rows(target: str, gone: DataFrame, made: DataFrame, series: Series = HOURLY, slots: int = 16) -> None:
    """Write ``made`` for the rows of ``gone`` (keys and time) into ``target``; parts that neither touches are not read.

    New parts are complete before the first one is replaced, and a rerun replaces them by the same rows.
    """
    spark = made.sparkSession
    row = f"struct({', '.join([*series.keys, series.time])}) AS __row"
    made = made.selectExpr("*", *_part(series, slots))
    schema = T.StructType([f for f in made.schema if f.name not in ("month", "slot")] + [T.StructField("month", T.StringType()), T.StructField("slot", T.LongType())])
    gone = gone.selectExpr(*_part(series, slots), row)
    parts = gone.select("month", "slot").distinct()
    try:
        stored = spark.read.schema(schema).parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    stay = stored.join(parts, ["month", "slot"], "left_semi").selectExpr("*", row).join(gone.select("__row"), "__row", "left_anti")
    whole = materialize(stay.select(*schema.names).unionByName(made), "parts")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "slot").parquet(target)


def correcting_writer(history: str, target: str, series: Series = HOURLY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: append a micro-batch to ``history`` and correct the features below ``target``.

    Rows may be late by any time: the features they move are computed again and replaced. A replayed batch replaces its own
    folder of the history and leads to the same features.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/batch={batch_id}")
        rows = batch.sparkSession.read.parquet(history).where(f"batch <= {batch_id}")
        gone, made = corrected_features(rows, f"batch = {batch_id}", series)
        replace_rows(target, gone, made, series)

    return write
