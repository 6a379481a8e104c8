"""Alert stretches on a stream: a condition that holds without a break is a session of evaluation instants.

Evaluations on the rule grid are native aggregations with a watermark, and what passes the condition goes into a session window
whose gap lies between one step and two, so the state of an uninterrupted condition is one row. A stretch is handed
out once the watermark has passed its end. A finite input ends with a closing row of a far time, which moves the
watermark past every open stretch; it comes from a folder of its own that the stream reads besides its input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.operators.requests import ERROR_RATE_LIMIT, HOLD_SECONDS, RATE_SECONDS, STEP_SECONDS
from tideframe.session import new_path
from tideframe.streaming.metrics import WATERMARK, append_to

CLOSING_TIME = "2200-01-01 00:00:00"


def error_rates(log: DataFrame, labels: Sequence[str] = ("endpoint",), watermark: str = WATERMARK) -> DataFrame:
    """labels, instant, rate: errors per second over the five minutes that end at each instant of the grid."""
    errors = log.where("status = 'error'").withWatermark("ts", watermark)
    ranges = errors.groupBy(*labels, F.window("ts", f"{RATE_SECONDS} seconds", f"{STEP_SECONDS} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return ranges.select(*labels, F.window_time("w").alias("instant"), F.expr(f"n / {float(RATE_SECONDS)!r}D").alias("rate"))


def gauge_instants(samples: DataFrame, labels: Sequence[str], value: str, look_back: int = RATE_SECONDS, step: int = STEP_SECONDS, late: int = 600) -> DataFrame:
    """labels, instant, value: the streaming form of :func:`tideframe.operators.requests.gauge_on_grid`.

    Every sample is handed to the instants it may be seen at; of those met at one instant the youngest counts. Samples may
    be ``late`` seconds late.
    """
    first = f"CAST(ceil(unix_micros(ts) / {step}e6D) AS BIGINT) * {step}L"
    seen = f"filter(sequence({first}, {first} + {look_back}L, {step}L), e -> e * 1000000L - unix_micros(ts) < {look_back * 1_000_000}L)"
    copies = samples.selectExpr(*labels, "ts", "event_id", value, f"explode({seen}) AS __at")
    copies = copies.withColumn("instant", F.timestamp_seconds("__at")).withWatermark("instant", f"{late + look_back + step} seconds")
    youngest = copies.groupBy(*labels, F.window("instant", f"{step} seconds").alias("w")).agg(F.max_by(value, F.struct("ts", "event_id")).alias(value))
    return youngest.select(*labels, F.window_time("w").alias("instant"), value)


def stretches(evaluations: DataFrame, labels: Sequence[str], condition: str, hold_seconds: int, value: str, shift: int, step: int = STEP_SECONDS) -> DataFrame:
    """labels, since, until, peak, firing: stretches of the evaluations over which ``condition`` held.

    ``instant`` is the event time that windows hand on, the last microsecond of the window; ``shift`` microseconds later is the evaluation.
    """
    gap = step * 1_500  # milliseconds: the next instant is within, the one after it is not
    on = evaluations.where(condition)
    held = on.groupBy(*labels, F.session_window("instant", f"{gap} milliseconds").alias("s")).agg(F.max(value).alias("peak"))
    at = "timestamp_micros(unix_micros({}) + {})"
    spans = held.selectExpr(*labels, f"{at.format('s.start', shift)} AS since", f"{at.format('s.end', shift - gap * 1000)} AS until", "peak")
    return spans.selectExpr(*labels, "since", "until", "peak", f"unix_micros(until) - unix_micros(since) >= {hold_seconds * 1_000_000}L AS firing")


def error_rate_alert(log: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Stretches of many errors per second, per endpoint."""
    return stretches(error_rates(log), ["endpoint"], f"rate > {limit!r}D", HOLD_SECONDS["HighErrorRate"], "rate", 1)


def health_alert(samples: DataFrame) -> DataFrame:
    """Stretches of evaluations that see a model unhealthy; a gauge is seen for five minutes."""
    # the instant of the grid is the start of its slot
    grid = gauge_instants(samples, ["model_type"], "health")
    return stretches(grid, ["model_type"], "health = 0", HOLD_SECONDS["ModelUnhealthy"], "health", 1 - STEP_SECONDS * 1_000_000)


def drain(stream: DataFrame, build: Callable[[DataFrame], DataFrame], closing: dict[str, str]) -> DataFrame:
    """All rows of ``build(stream)`` for a finite input, stretches that are open at its end included.

    The first run reads the input to its end. Then a closing row is written to the folder that the same query reads besides,
    and a second run from the same checkpoint hands out what was still open. ``closing`` gives columns of that row that it
    needs to reach the watermark; the others are null, and its condition does not hold.
    """
    spark = stream.sparkSession
    last, target, state = new_path(spark, "closing"), new_path(spark, "stretches"), new_path(spark, "stream-state")
    values = {"ts": f"TIMESTAMP '{CLOSING_TIME}'"} | closing
    row = spark.range(1).select(*[F.expr(values.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in stream.schema])
    row.limit(0).write.parquet(last)
    both = stream.unionByName(spark.readStream.schema(row.schema).parquet(last))
    out = build(both)
    append_to(out, target, state).awaitTermination()
    row.write.mode("append").parquet(last)
    append_to(out, target, state).awaitTermination()
    return spark.read.schema(out.schema).parquet(target)
