"""Training statistics and drift of rows against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import number
from tideframe.functions.numeric import numeric_columns
from tideframe.operators.profile import describe_stats

ALERT_RATIO = 0.3  # fixed value: drift ratio above which the alert condition holds


def drift_features(df: DataFrame) -> list[str]:
    """Default features of the detector: every numeric column but the target."""
    return numeric_columns(df, {"price"})


def training_stats(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Seven statistics per feature; features that are absent or hold no value are left out."""
    features = [c for c in (features or drift_features(df)) if c in df.columns]
    stats = describe_stats(df, features).where("count > 0").withColumnRenamed("column_name", "feature")
    return stats.select("feature", "mean", "std", "min", "max", "median", "q25", "q75")


def drift_bounds(stats: DataFrame) -> DataFrame:
    """Observed range per feature; three deviations around the mean where no range is given."""
    have = set(stats.columns)
    low = "mean - 3 * std" if "min" not in have else "coalesce(min, mean - 3 * std)"
    high = "mean + 3 * std" if "max" not in have else "coalesce(max, mean + 3 * std)"
    return stats.selectExpr("feature", f"{low} AS low", f"{high} AS high")


def observed_bounds(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """The bounds that :func:`drift_bounds` takes from training statistics, from one wide aggregation: ranges need no quartiles."""
    features = [c for c in (features or drift_features(df)) if c in df.columns]
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, low double, high double")
    names = [F.lit(c).alias("feature") for c in features]
    ranges = [F.struct(n, F.min(F.col(f"`{c}`").cast("double")).alias("low"), F.max(F.col(f"`{c}`").cast("double")).alias("high")) for n, c in zip(names, features, strict=True)]
    return df.agg(F.array(*ranges).alias("bounds")).select(F.inline("bounds")).where("low IS NOT NULL")


def drift_flags(df: DataFrame, bounds: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per scored row and feature. A feature without bounds, or without a value, never drifts.

    The bounds hold at most one row per requested feature, which limits what is broadcast.
    """
    values = [f"CAST({c} AS DOUBLE) AS {c}" for c in features]
    long = df.selectExpr(*keys, *values).unpivot(list(keys), list(features), "feature", "value")
    known = F.broadcast(bounds.where(F.col("feature").isin(list(features))))
    flag = "coalesce(value < low OR value > high, false) AS is_drift"
    return long.join(known, "feature", "left").selectExpr(*keys, "feature", "value", flag)


def collect_bounds(bounds: DataFrame) -> dict[str, tuple[float, float]]:
    """Bounds as a dictionary: one entry per feature column."""
    return {r["feature"]: (r["low"], r["high"]) for r in bounds.collect()}


def drift_ratio(df: DataFrame, bounds: dict[str, tuple[float, float]], features: Sequence[str]) -> DataFrame:
    """Add ``drift_ratio``: drifted share of all supplied features, known or not.

    A row-wise projection with the bounds as literals: no shuffle, and it runs on streams as is.
    """
    terms = []
    for c in features:
        if c in bounds and None not in bounds[c]:
            low, high = bounds[c]
            terms.append(f"CAST(coalesce({c} < {number(low)} OR {c} > {number(high)}, false) AS INT)")
    drifted = " + ".join(terms) or "0"
    ratio = f"({drifted}) / {float(len(features))!r}D" if features else "0D"
    return df.selectExpr("*", f"{ratio} AS drift_ratio")


def drift_detections(flags: DataFrame, by: Sequence[str] = ("model_type", "feature")) -> DataFrame:
    """Number of drifted values per label set."""
    return flags.where("is_drift").groupBy(*by).agg(F.count(F.lit(1)).alias("detections"))
