"""The given tables and the relations derived from them.

``events`` plays the part of the tick feed and of the request log: every event type is one series
(hour close, traded amount, tick count) and also one endpoint whose value is a response time.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.session import pin_utc

BASE_COLUMNS = ["price", "market_cap", "total_volume"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with ``ts`` as an instant (it is stored without a zone and means UTC)."""
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_order(time: str = "ts", event_id: str = "event_id") -> Column:
    """Total order (time, id) as one number, so that latest-value aggregates stay hash aggregates."""
    micros = F.unix_micros(time).cast("decimal(38,0)")
    return micros * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col(event_id)


def market_hourly(events_df: DataFrame) -> DataFrame:
    """Hourly series per event type: closing value, exact traded amount, number of ticks.

    One map-side combined hash aggregation. The hourly table is a small fraction of the events and
    feeds several readers, so it is kept (spilling to disk) instead of being derived again.
    """
    hourly = events_df.groupBy(F.col("event_type").alias("coin_id"), F.date_trunc("hour", "ts").alias("timestamp")).agg(
        F.max_by("value", event_order()).alias("price"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("market_cap"),
        F.count(F.lit(1)).cast("double").alias("total_volume"),
    )
    return hourly.persist(StorageLevel.MEMORY_AND_DISK)


def market_dirty(hourly: DataFrame) -> DataFrame:
    """Hourly series with missing values, repeated hours and an ingest order that is not time order.

    Every sixth hour is delivered again later with another price (the first delivery must win);
    every eleventh hour had an earlier delivery with another price (that one must win).
    """
    hour, day = F.hour("timestamp"), F.dayofmonth("timestamp")
    base = hourly.select(
        "coin_id",
        "timestamp",
        F.when(hour % 7 != 0, F.col("price")).alias("price"),
        F.when((day + hour) % 5 != 0, F.col("market_cap")).alias("market_cap"),
        F.when(hour % 9 != 4, F.col("total_volume")).alias("total_volume"),
        ((day * 37 + hour * 11) % 101 * 10).cast("bigint").alias("ingest_seq"),
    )
    # one pass over the hours: each row carries the shifts of its deliveries
    shift = F.filter(
        F.array(F.lit(0), F.when(hour % 6 == 1, F.lit(1)), F.when(hour % 11 == 5, F.lit(-1))), lambda d: d.isNotNull()
    )
    return base.withColumn("__shift", F.explode(shift)).select(
        "coin_id",
        "timestamp",
        (F.col("price") + F.col("__shift")).alias("price"),
        "market_cap",
        "total_volume",
        (F.col("ingest_seq") + F.col("__shift")).alias("ingest_seq"),
    )


def request_log(events_df: DataFrame) -> DataFrame:
    """Service requests seen in the event table: endpoint, status, response time, serving model."""
    latency = F.col("value") / F.lit(100.0)
    return events_df.select(
        "event_id",
        "ts",
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.when(F.col("event_type").isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        latency.alias("latency_s"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model_type"),
        F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * 10000).cast("bigint")).alias("end_ts"),
    )


def naive_predictions(hourly: DataFrame, **block_options) -> DataFrame:
    """Forecast every hour by the hour before it; the first hour of a series has no forecast."""
    from tideframe.operators.features import previous_row

    return previous_row(hourly, ["price"], **block_options).select(
        "coin_id", "timestamp", F.col("price").alias("actual"), F.col("prev_price").alias("predicted_price")
    )
