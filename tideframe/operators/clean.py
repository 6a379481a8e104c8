"""Cleaning and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import number
from tideframe.functions.numeric import is_infinite
from tideframe.plans.ordered import HOURLY, Series, forward_back_fill, forward_fill
from tideframe.plans.quantiles import column_facts, exact_quantiles
from tideframe.sources.tables import BASE_COLUMNS


def dedupe_first(df: DataFrame, series: Series = HOURLY, order: str | None = "ingest_seq") -> DataFrame:
    """One row per (series, time): the one that was delivered first.

    A minimum over (delivery, row) combines on the map side, so an hour that was delivered a
    billion times still reaches the reducer as one row per input partition.
    """
    keys = [*series.keys, series.time]
    rest = [c for c in df.columns if c not in keys]
    if order is None or order not in df.columns:
        raise ValueError("rows have no order of their own: name the delivery order column")
    ranked = [order, *[c for c in rest if c != order]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null (or NaN); infinity is a value and stays."""
    return df.dropna("any", subset=list(columns) if columns else None)


def ffill(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS, series: Series = HOURLY) -> DataFrame:
    """Carry the last known value forward without limit."""
    return forward_fill(df, series, list(columns))


def ffill_bfill(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS, series: Series = HOURLY) -> DataFrame:
    """Forward fill, then give leading gaps the first known value."""
    return forward_back_fill(df, series, list(columns))


def clean_series(df: DataFrame, series: Series = HOURLY, order: str | None = "ingest_seq") -> DataFrame:
    """First delivery wins, forward fill in time order, drop what is still incomplete."""
    kept = dedupe_first(df, series, order)
    columns = [c for c in kept.columns if c not in {*series.keys, series.time, order}]
    return drop_missing(ffill(kept, columns, series))


def clean_series_strict(df: DataFrame, series: Series = HOURLY, order: str | None = "ingest_seq") -> DataFrame:
    """Drop incomplete rows, then first delivery wins; nothing is filled."""
    complete = drop_missing(df)
    return dedupe_first(complete, series, order) if order and order in df.columns else complete


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two passes of exact median filling.

    First nulls take the median that still counts infinities as numbers. Then infinities become
    nulls and take the median of what the first pass produced.
    """
    facts = column_facts(df, list(columns))
    gaps = [c for c, f in facts.items() if f["nulls"]]
    endless = [c for c, f in facts.items() if f["below"] + f["above"]]
    first = exact_quantiles(df, gaps, [0.5], facts=facts)
    filled = _fill_with(df, {c: q[0] for c, q in first.items()})
    # a fill value can itself be infinite, so columns with infinities are looked at again
    finite = filled.withColumns({c: F.when(~is_infinite(c), F.col(c)) for c in endless}) if endless else filled
    second = exact_quantiles(finite, endless, [0.5])
    return _fill_with(finite, {c: q[0] for c, q in second.items()})


def _fill_with(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.expr(f"coalesce({c}, {number(v)})") for c, v in values.items()}) if values else df
