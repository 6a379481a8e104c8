"""Exact quantiles and average ranks that never gather a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

BINS = 2048


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) rows. Aggregating these by name stays one small generated loop for any width."""
    return df.selectExpr(*[f"CAST({c} AS DOUBLE) AS {c}" for c in columns]).unpivot([], list(columns), "column_name", "value")


FACTS = {
    "count": "count(value)",
    "nulls": "count_if(value IS NULL)",
    "mean": "avg(value)",
    "std": "stddev_samp(value)",
    "std_pop": "stddev_pop(value)",
    "min": "min(value)",
    "max": "max(value)",
    "below": "count_if(value = double('-Infinity'))",
    "above": "count_if(value = double('Infinity'))",
    "low": "min(CASE WHEN abs(value) < double('Infinity') THEN value END)",
    "high": "max(CASE WHEN abs(value) < double('Infinity') THEN value END)",
}


def column_facts(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """Counts, moments and range of every column in one map-side combined pass; one row per column comes back."""
    if not columns:
        return {}
    facts = long_form(df, columns).groupBy("column_name").agg(*[F.expr(e).alias(n) for n, e in FACTS.items()])
    return {r["column_name"]: r for r in facts.collect()}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], facts: dict[str, Row] | None = None
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per column, nulls ignored; columns without values are left out.

    The wanted order statistics are closed in by repeated counting: every pass splits the interval that
    holds a statistic into bins, counts them in one map-side combined aggregation and keeps the bin
    with the statistic, until the bin is one single value. Two passes settle thousands of values, three about 10^9.
    """
    facts = column_facts(df, list(columns)) if facts is None else facts
    sizes = {c: facts[c]["count"] for c in columns if c in facts and facts[c]["count"]}
    known = list(sizes)
    if not known:
        return {}
    spots = {c: [p * (sizes[c] - 1) for p in probs] for c in known}
    ranks = {(c, r) for c in known for s in spots[c] for r in (math.floor(s), math.ceil(s))}
    found: dict[tuple[str, int], float] = {}
    still_open: dict[tuple[str, int], tuple[float, float, int]] = {}
    for c, r in ranks:
        if r < facts[c]["below"]:
            found[c, r] = -math.inf
        elif r >= sizes[c] - facts[c]["above"]:
            found[c, r] = math.inf
        else:
            still_open[c, r] = (facts[c]["low"], facts[c]["high"], r - facts[c]["below"])
    while still_open:
        for key in [k for k, (lo, hi, _) in still_open.items() if lo == hi]:
            found[key] = still_open.pop(key)[0]
        if still_open:
            still_open = _narrow(df, still_open)
    return {c: [_between(found, c, s) for s in spots[c]] for c in known}


def _between(found: dict, c: str, spot: float) -> float:
    low, high = found[c, math.floor(spot)], found[c, math.ceil(spot)]
    return low if low == high else low + (high - low) * (spot - math.floor(spot))


def _width(lo: float, hi: float) -> float:
    """Half the width of an interval, or 0 where it is too narrow to divide by."""
    width = hi / 2 - lo / 2
    return 0.0 if width == 0 or math.isinf(1 / width) else width


def _narrow(df: DataFrame, still_open: dict) -> dict:
    """One counting pass over all open intervals; returns the bin that holds each statistic."""
    intervals = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in still_open.items()})
    number = {interval: i for i, interval in enumerate(intervals)}
    rows = [(i, c, lo, hi, _width(lo, hi)) for (c, lo, hi), i in number.items()]
    table = df.sparkSession.createDataFrame(rows, "id int, column_name string, from double, to double, width double")
    # a value meets the few open intervals of its column; the table has at most six rows per column
    inside = long_form(df, sorted({c for c, _, _ in intervals})).join(F.broadcast(table), "column_name").where("value BETWEEN from AND to")
    part = f"CASE WHEN width = 0 THEN CAST(value > from AS INT) ELSE least({BINS - 1}, CAST((value / 2 - from / 2) / width * {BINS} AS INT)) END AS bin"
    counted = (
        inside.selectExpr("id", part, "value")
        .groupBy("id", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    # at most BINS rows per interval, and as many intervals as open statistics
    before = Window.partitionBy("id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hits = " OR ".join(
        f"(id = {number[c, lo, hi]} AND before <= {rank} AND {rank} < before + n)"
        for (c, _), (lo, hi, rank) in still_open.items()
    )
    rows = counted.where(hits).collect()  # one row per open statistic
    out = {}
    for (c, r), (lo, hi, rank) in still_open.items():
        mine = number[c, lo, hi]
        hit = next(x for x in rows if x["id"] == mine and x["before"] <= rank < x["before"] + x["n"])
        out[c, r] = (hit["lo"], hit["hi"], rank - hit["before"])
    return out


#: Distinct values that one task sorts when ranks are taken.
RANGE_VALUES = 100_000


def average_ranks(values: DataFrame, column: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """Distinct values of ``column`` with their average rank (ties share the mean of their places).

    Equal values are counted before anything is sorted; the distinct values are cut into ranges of
    about ``range_values``, so that each task sorts one range and earlier ranges enter as one total.
    """
    counted = values.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    buckets = -(-counted.count() // range_values)
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    cuts = counted.agg(F.expr(f"percentile_approx({column}, array({shares}), 10000)").alias("cuts")).first()["cuts"] if shares else []
    known = ", ".join(f"{float(v)!r}D" for v in sorted(set(cuts or [])))
    bucket = f"size(filter(array({known}), x -> x < {column}))" if known else "0"
    counted = counted.selectExpr("*", f"{bucket} AS __range")
    totals = counted.groupBy("__range").agg(F.sum("__n").alias("__total"))  # at most ``buckets`` rows
    totals = totals.selectExpr(
        "__range", "coalesce(sum(__total) OVER (ORDER BY __range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before"
    )
    inside = f"OVER (PARTITION BY __range ORDER BY {column} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return counted.join(totals, "__range").selectExpr(
        column, f"__before + coalesce(sum(__n) {inside}, 0) + (__n + 1) / 2D AS rank"
    )
