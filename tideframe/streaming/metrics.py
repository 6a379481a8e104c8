"""Streaming forms of the request metrics.

Stateful steps are native windowed aggregations with a watermark. What needs an order over windows
(quantile columns, alert stretches) is a batch query over the stored windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideframe.operators.requests import (
    RATE_SECONDS,
    REQUEST_BUCKETS,
    STEP_SECONDS,
    cumulative_counts,
    ranges_of,
    slot_measures,
)
from tideframe.session import new_path, pin_utc

WATERMARK = "10 minutes"
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Events as a file stream, oldest file first. ``path`` is a folder or a pattern of files."""
    pin_utc(spark)
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def slot_stream(
    log: DataFrame, labels: Sequence[str], measures: dict[str, str], step: int = STEP_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """Measures per tumbling slot of event time; a slot is final once the watermark has passed its end.

    Ranges that slide over slots are added up from the stored slots, so the state holds every event once.
    """
    counted = log.withWatermark("ts", watermark).groupBy(*labels, F.window("ts", f"{step} seconds").alias("w"))
    counted = counted.agg(*[F.expr(e).alias(n) for n, e in measures.items()])
    return counted.select(*labels, F.col("w.start").alias("__slot"), *measures)


def slots_to_the_end(
    stream_log: DataFrame, log: DataFrame, labels: Sequence[str], measures: dict[str, str], step: int = STEP_SECONDS
) -> DataFrame:
    """All slots of a finite input: those the stream has closed, and the ones still open when it ends.

    ``log`` is the same input as a batch; only its rows behind the last watermark are counted there.
    """
    spark = log.sparkSession
    path, stream = new_path(spark, "slots"), slot_stream(stream_log, labels, measures, step)
    query = append_to(stream, path)
    query.awaitTermination()
    reached = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p["eventTime"] or {})]
    closed = spark.read.schema(stream.schema).parquet(path)
    behind = F.lit(max(reached, default="1970-01-01T00:00:00.000Z")).cast("timestamp")
    tail = slot_measures(log.where(F.col("ts") > behind - F.expr(f"INTERVAL {step} SECOND")), labels, measures, step=step)
    return closed.unionByName(tail.where(F.col("__slot") + F.expr(f"INTERVAL {step} SECOND") > behind))


def counter_rate(stream_log: DataFrame, log: DataFrame, labels: Sequence[str] = ("endpoint", "status")) -> DataFrame:
    """Events per second over five minutes, from the slots of a stream."""
    slots = slots_to_the_end(stream_log, log, labels, {"n": "count(1)"})
    return ranges_of(slots, labels, ["n"]).selectExpr(*labels, "window_end", f"n / {float(RATE_SECONDS)!r}D AS rate")


def histogram_ranges(
    stream_log: DataFrame,
    log: DataFrame,
    labels: Sequence[str] = ("endpoint",),
    value: str = "latency_s",
    buckets: Sequence[float] = REQUEST_BUCKETS,
) -> DataFrame:
    """Bucket counts per range, from the slots of a stream; ``quantiles_of`` turns them into quantiles."""
    measures = cumulative_counts(value, buckets) | {"total": "count(1)"}
    return ranges_of(slots_to_the_end(stream_log, log, labels, measures), labels, list(measures))


def append_to(stream: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Start a query that appends what is available now to a Parquet folder, exactly once per checkpoint."""
    checkpoint = checkpoint or new_path(stream.sparkSession, "stream-state")
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, label: str = "stream") -> DataFrame:
    """Drain a stream into a fresh folder and read the result."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    append_to(stream, path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
