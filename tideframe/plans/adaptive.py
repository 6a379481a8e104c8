"""Buckets of ordered passes that follow the data.

Calendar buckets hold few rows where rows are spread over time, and all of them where one key has its rows in one
second. :func:`cut_full_buckets` counts the buckets first. Those above a bound are cut again: their range of time is split into
slots of equal width, slots are counted, and runs of slots that hold about half the bound become a bucket each. A slot that is
still too full is cut by its own range in the next round; rows of one instant are cut by the tie breakers. What
ordered passes carry from bucket to bucket then flows through the new ones like through any other.

Each round reads the rows once for the ranges and once for the slots, and only tables of full buckets and their slots are joined.
A frame without a full bucket costs one count. Only rows that agree in time and in all whole-number tie breakers stay together,
since nothing orders them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideframe.plans.ordered import GROUP, Series, grouped
from tideframe.session import materialize

PATH = "__path"
#: Rows of a bucket, and slots that one bucket is split into in a round at most.
FULL, SLOTS = 200_000, 10_000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def order_numbers(df: DataFrame, series: Series) -> list[str]:
    """The order of a series as whole numbers, as far as time and tie breakers are such."""
    numbers = [f"unix_micros(CAST({series.time} AS TIMESTAMP))"]
    for tie in series.ties:
        if not isinstance(df.schema[tie].dataType, _WHOLE):
            break
        numbers.append(f"CAST({tie} AS BIGINT)")
    return numbers


def cut_full_buckets(df: DataFrame, series: Series, most: int = FULL) -> tuple[DataFrame, Series]:
    """The rows with their place among cut buckets in ``PATH``, and the series that uses it."""
    numbers = order_numbers(df, series)
    names = [f"__order{i}" for i in range(len(numbers))]
    rows = df.selectExpr("*", f"CAST(array() AS ARRAY<BIGINT>) AS {PATH}", *[f"{e} AS {n}" for e, n in zip(numbers, names, strict=True)])
    series = replace(series, path=PATH)
    while True:
        cuts = full_buckets(rows, series, names, most)
        if cuts is None:
            return rows.drop(*names), series
        full, parts = cuts
        marked = grouped(rows, series).join(full, GROUP, "left").withColumn("__slot", F.expr(_slot(names)))
        marked = marked.join(parts, [GROUP, "__slot"], "left")
        path = f"CASE WHEN __part IS NULL THEN {PATH} ELSE concat({PATH}, array(__part)) END AS {PATH}"
        rows = marked.selectExpr(*[f"`{c}`" for c in rows.columns if c != PATH], path)


def _slot(names: list[str]) -> str:
    """Slot of a row of a full bucket by the first number that varies in it; rows without the number come first."""
    value = f"CASE __by {' '.join(f'WHEN {i} THEN {n}' for i, n in enumerate(names))} END"
    inside = f"(CAST({value} AS DECIMAL(20, 0)) - __low) DIV __width"
    return f"CASE WHEN __by IS NOT NULL THEN coalesce({inside}, -1L) END"


def full_buckets(rows: DataFrame, series: Series, names: list[str], most: int) -> tuple[DataFrame, DataFrame] | None:
    """(full, parts): how buckets above the bound are split into slots, and the part of each slot; None if no bucket can be split."""
    facts = [F.expr(f"{f}({n})").alias(f"__{f}{i}") for i, n in enumerate(names) for f in ("min", "max", "count")]
    counted = grouped(rows, series).groupBy(GROUP).agg(F.count(F.lit(1)).alias("__rows"), *facts).where(f"__rows > {most}")
    varies = [f"WHEN __min{i} < __max{i} OR (__count{i} > 0 AND __count{i} < __rows) THEN {i}" for i in range(len(names))]
    picked = counted.selectExpr("*", f"CASE {' '.join(varies)} END AS __by").where("__by IS NOT NULL")
    bounds = [f"CASE __by {' '.join(f'WHEN {i} THEN CAST(__{f}{i} AS DECIMAL(20, 0))' for i in range(len(names)))} END AS __{f}" for f in ("min", "max")]
    slots = f"least({SLOTS}, 4 * CAST(ceil(__rows / {most}) AS INT))"
    full = picked.selectExpr(GROUP, "__rows", "__by", *bounds).selectExpr(
        GROUP, "__by", "__min AS __low", f"CAST(((__max - __min) DIV {slots}) + 1 AS DECIMAL(20, 0)) AS __width"
    )
    full = materialize(full, "full")
    if full.isEmpty():
        return None
    inside = grouped(rows, series).join(full, GROUP).selectExpr(GROUP, f"{_slot(names)} AS __slot")
    # at most SLOTS rows per bucket
    half = max(1, most // 2)
    before = f"OVER (PARTITION BY {GROUP} ORDER BY __slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    parts = inside.groupBy(GROUP, "__slot").agg(F.count(F.lit(1)).alias("__n")).withColumn("__big", F.expr(f"CAST(__n > {half} AS INT)"))
    # a slot above half the bound is a part of its own, so every round narrows the range of what is still too full
    part = f"coalesce(sum(__n) {before}, 0L) DIV {half} + 2 * coalesce(sum(__big) {before}, 0L) + __big"
    parts = parts.selectExpr(GROUP, "__slot", f"{part} AS __part")
    return full, materialize(parts, "parts")
