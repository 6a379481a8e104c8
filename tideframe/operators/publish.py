"""Row lookups, sinks, published datasets and content records."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.plans.ordered import HOURLY, Series


def time_range(df: DataFrame, time: str = "timestamp", start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows between ``start`` and ``end``, both included, either may be left out.

    A date without a time is its midnight, so an end date covers only its first instant.
    """
    if start is not None and end is not None:
        first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
        if not df.sparkSession.range(1).select(F.coalesce(first < last, F.lit(False))).first()[0]:
            raise ValueError("start must be an instant before end")
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(time) <= F.lit(end).cast("timestamp"))
    return df


def at_time(df: DataFrame, moment: str, time: str = "timestamp") -> DataFrame:
    """Rows at one instant; an error if there is none."""
    rows = df.where(F.col(time) == F.lit(moment).cast("timestamp"))
    if rows.isEmpty():
        raise ValueError(f"{moment} not found")
    return rows


def latest_row(df: DataFrame, series: Series = HOURLY) -> DataFrame:
    """The newest row of every series, combined on the map side."""
    return _edge_row(df, series, F.max_by)


def first_row(df: DataFrame, series: Series = HOURLY) -> DataFrame:
    """The oldest row of every series."""
    return _edge_row(df, series, F.min_by)


def _edge_row(df: DataFrame, series: Series, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in series.keys]
    edge = df.groupBy(*series.keys).agg(pick(F.struct(*rest), F.col(series.time)).alias("__row"))
    return edge.select(*[F.col(c) if c in series.keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def row_text(df: DataFrame, columns: list[str]) -> str:
    """SQL text of a row: each value with its length before it, ``n;`` for null; times as microseconds.

    No two different rows have the same text: lengths keep values apart and a null is not an empty text.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    parts = []
    for c in columns:
        value = f"unix_micros(CAST(`{c}` AS TIMESTAMP))" if kinds[c].startswith("timestamp") else f"`{c}`"
        text = f"CAST({value} AS STRING)"
        parts.append(f"CASE WHEN `{c}` IS NULL THEN 'n;' ELSE concat(char_length({text}), ':', {text}, ';') END")
    return f"concat({', '.join(parts)})"


def fingerprint_columns(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Row count and order-free digest: sums of two 60-bit parts of every row's MD5."""
    digest = f"md5({row_text(df, columns or df.columns)})"
    part = "coalesce(sum(CAST(conv(substring({}, {}, 15), 16, 10) AS DECIMAL(38, 0))), 0)"
    return [
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"concat({part.format(digest, 1)}, '-', {part.format(digest, 16)})").alias("digest"),
    ]


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Fingerprint of a whole table; works at any size and does not depend on row order."""
    return df.agg(*fingerprint_columns(df))


def content_manifest(rows: DataFrame) -> DataFrame:
    """Rows, digest and content-addressed key of every file of a stored dataset, just as read from it.

    The rows of a file are digested by the tasks that read them, so files of any size are spread over tasks.
    """
    keyed = rows.select("*", F.col("_metadata.file_path").alias("__path"))
    files = keyed.groupBy("__path").agg(*fingerprint_columns(rows))
    return files.selectExpr(
        "substring_index(__path, '/', -1) AS file_name",
        "rows",
        "digest",
        "concat(substring(md5(digest), 1, 2), '/', substring(md5(digest), 3)) AS content_key",
    )


def write_csv(df: DataFrame, path: str) -> str:
    """CSV sink with a header; the first column is the time."""
    df.write.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """One JSON document per row, in one file: reports are a handful of rows."""
    df.coalesce(1).write.json(path)
    return path


def publish_dataset(df: DataFrame, base: str, name: str, run_ts: str) -> DataFrame:
    """Write a dataset under a versioned path, read it back and compare counts and digests.

    Works on any file system Spark can write to. The metadata row says whether the copy is whole.
    """
    path = f"{base.rstrip('/')}/processed/{run_ts}_{name}"
    written = Observation("published")  # taken while the rows are written, so they are derived once
    df.observe(written, *fingerprint_columns(df)).write.mode("error").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    have = table_fingerprint(stored).first().asDict()
    row = (name, f"processed/{run_ts}_{name}", have["rows"], have["digest"], written.get == have)
    return df.sparkSession.createDataFrame([row], "name string, key string, rows bigint, digest string, verified boolean")


MANIFEST_SCHEMA = "name string, version string, path string, columns string, rows bigint, digest string"


def stage_version(df: DataFrame, base: str, name: str, version: str) -> tuple[str, dict]:
    """Write a dataset into a staging folder of its own; no reader sees it. Returns its path below ``base`` and its fingerprint."""
    path = f"staged/{name}/{version}-{uuid.uuid4().hex}"
    written = Observation("staged")
    df.observe(written, *fingerprint_columns(df)).write.mode("error").parquet(f"{base.rstrip('/')}/{path}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{base.rstrip('/')}/{path}")
    have = table_fingerprint(stored).first().asDict()
    if written.get != have:
        raise RuntimeError(f"{path} holds other rows than were written")
    return path, have


def publish_version(df: DataFrame, base: str, name: str, version: str) -> DataFrame:
    """Publish in two phases: stage and verify the rows, then write the manifest that makes them visible.

    A run that stops before the manifest leaves nothing that readers see. Publishing the same rows under the same version again keeps
    the first copy; other rows under a published version are an error.
    """
    spark = df.sparkSession
    known = _manifest(spark, base, name, version)
    if known is not None:
        have = table_fingerprint(df).first().asDict()
        if (known["rows"], known["digest"]) != (have["rows"], have["digest"]):
            raise ValueError(f"version {version} of {name} is published with other rows")
        return spark.createDataFrame([known], MANIFEST_SCHEMA)
    path, have = stage_version(df, base, name, version)
    record = spark.createDataFrame([(name, version, path, df.schema.json(), have["rows"], have["digest"])], MANIFEST_SCHEMA)
    record.coalesce(1).write.mode("error").json(f"{base.rstrip('/')}/manifests/{name}/{version}")
    return record


def versions(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The manifests of all published versions; a manifest folder without its row is not published yet."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{base.rstrip('/')}/manifests/{name}/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def _manifest(spark: SparkSession, base: str, name: str, version: str | None = None) -> Row | None:
    found = versions(spark, base, name)
    found = found if version is None else found.where(F.col("version") == version)
    return found.orderBy(F.desc("version")).first()


def newest_version(spark: SparkSession, base: str, name: str) -> str | None:
    """The published version that sorts last."""
    found = _manifest(spark, base, name)
    return found and found["version"]


def read_version(spark: SparkSession, base: str, name: str, version: str | None = None) -> DataFrame:
    """A published version, the newest unless named; only manifests say what there is."""
    found = _manifest(spark, base, name, version)
    if found is None:
        raise FileNotFoundError(f"no published version {version or ''} of {name}")
    schema = T.StructType.fromJson(json.loads(found["columns"]))
    return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{found['path']}")


def publish_with_fallback(df: DataFrame, base: str, backup: str, name: str, run_ts: str) -> DataFrame:
    """Publish to ``base``; if that fails keep the dataset under ``backup`` instead."""
    try:
        return publish_dataset(df, base, name, run_ts).withColumn("fallback", F.lit(False))
    except (AnalysisException, Py4JJavaError):  # the path is taken or the storage cannot be written: keep a backup copy
        return publish_dataset(df, backup, name, run_ts).withColumn("fallback", F.lit(True))


def run_summary(gate: DataFrame, profile: DataFrame, published: DataFrame, best: DataFrame) -> DataFrame:
    """One row over the stages of a run: rows, gate, columns, storage, best model. Every input is one row."""
    parts = [
        gate.select("total_rows", "quality_passed"),
        profile.select(F.col("dataset_columns").alias("features_count")),
        published.select(F.col("key").alias("storage_key"), F.col("verified").alias("uploaded")),
        best.where("is_best").select(F.col("model").alias("best_model"), F.col("test_rmse").alias("best_rmse")),
    ]
    out = parts[0].withColumn("__run", F.lit(1))
    for part in parts[1:]:
        out = out.join(part.withColumn("__run", F.lit(1)), "__run", "left")
    return out.drop("__run").withColumn("status", F.expr("CASE WHEN quality_passed AND uploaded THEN 'SUCCESS' ELSE 'FAILED' END"))
