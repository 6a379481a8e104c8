"""File sources: market-chart payloads, CSV series, newest file, stored statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions.numeric import null_safe_doubles

PAYLOAD_SCHEMA = "prices array<array<double>>, market_caps array<array<double>>, total_volumes array<array<double>>"
SERIES_SCHEMA = "timestamp timestamp, price double, market_cap double, total_volume double"
STATS_SCHEMA = "feature string, mean double, std double, min double, max double, median double, q25 double, q75 double"


def read_market_chart(spark: SparkSession, path: str, keys: str = "coin_id string", multi_line: bool = False) -> DataFrame:
    """Raw payload documents: three parallel lists of [epoch ms, value], plus series keys if the source has them."""
    schema = f"{keys}, {PAYLOAD_SCHEMA}" if keys else PAYLOAD_SCHEMA
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def flatten_market_chart(payload: DataFrame, strict: bool = False) -> DataFrame:
    """One row per list position; the time comes from the price list, empty items give NULL.

    Lists of different length, and with ``strict`` empty items, raise an error.
    """
    keys = [c for c in payload.columns if c not in ("prices", "market_caps", "total_volumes")]
    aligned = "size(prices) = size(market_caps) AND size(prices) = size(total_volumes)"
    checked = payload.where("size(prices) > 0").selectExpr(
        *keys,
        f"CASE WHEN {aligned} THEN arrays_zip(prices, market_caps, total_volumes)"
        " ELSE raise_error('payload lists differ in length') END AS z",
    )
    points = checked.selectExpr(*keys, "inline(z)")
    value = "get({0}, 1)"
    if strict:
        value = "CASE WHEN {0} IS NULL OR {0}[1] IS NULL THEN raise_error('payload list has an empty item') ELSE {0}[1] END"
    rows = points.selectExpr(
        *keys,
        "timestamp_millis(CAST(prices[0] AS BIGINT)) AS timestamp",
        "prices[1] AS price",
        f"{value.format('market_caps')} AS market_cap",
        f"{value.format('total_volumes')} AS total_volume",
    )
    return null_safe_doubles(rows)


def require_prices(payload: DataFrame) -> DataFrame:
    """The payload itself, or an error if no document carries a price.

    Documents without prices beside others are no error; :func:`without_prices` finds them.
    """
    if payload.where("size(prices) > 0").isEmpty():
        raise ValueError("the payload holds no price at all")
    return payload


def without_prices(payload: DataFrame) -> DataFrame:
    """Documents that :func:`flatten_market_chart` makes no row of."""
    return payload.where("coalesce(size(prices), 0) <= 0")


def to_market_chart(hourly: DataFrame) -> DataFrame:
    """Payload documents, one per series and day, so a document never grows with the series."""
    item = "array(CAST(unix_millis(timestamp) AS DOUBLE), {})"
    lists = {"prices": "price", "market_caps": "market_cap", "total_volumes": "total_volume"}
    grouped = hourly.groupBy("coin_id", F.to_date("timestamp").alias("day"))
    return grouped.agg(
        *[F.expr(f"sort_array(collect_list({item.format(c)}))").alias(n) for n, c in lists.items()]
    ).drop("day")


def read_series_csv(spark: SparkSession, path: str, schema: str = SERIES_SCHEMA) -> DataFrame:
    """CSV with a header and pinned types; NaN text becomes NULL."""
    reader = spark.read.schema(schema).option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return null_safe_doubles(reader.csv(path))


def latest_version(spark: SparkSession, base: str, prefix: str = "processed_") -> DataFrame:
    """The dataset below ``base`` whose folder name ``<prefix>...`` sorts last; only names are listed, one folder is read."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{prefix}*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [f.getPath().toString() for f in found or [] if f.isDirectory()]
    if not names:
        raise FileNotFoundError(f"no {prefix}* below {base}")
    return spark.read.parquet(max(names))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Stored training statistics, one document per feature."""
    return spark.read.schema(STATS_SCHEMA).json(path)
