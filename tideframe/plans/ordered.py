"""Ordered computations over long series without putting a whole series into one task.

A series is cut into calendar buckets. Rows are only ever sorted inside one (series, bucket);
what must flow from earlier buckets (row counts, running totals, last known values) is computed
from one small row per bucket and joined back. Where a series has very many buckets a second,
coarse level keeps that small table spread out too: fine buckets are accumulated inside a coarse
bucket, coarse buckets inside the series.

The rows are read twice, once for the bucket table and once for the result, so hand in a stored
or persisted frame when they are costly to derive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, COARSE, GROUP = "__bucket", "__coarse", "__group"


@dataclass(frozen=True)
class Series:
    """How rows of a frame form series: key columns, time column, tie breakers and bucket widths.

    ``fine`` should hold at most a few hundred thousand rows of one series: ``month`` suits hourly
    series, ``second`` suits raw event logs. ``coarse`` is for series with more than about a
    million fine buckets. ``path`` names the column of :mod:`tideframe.plans.adaptive` by which full
    buckets are cut again.
    """

    keys: tuple[str, ...] = ("coin_id",)
    time: str = "timestamp"
    ties: tuple[str, ...] = ()
    fine: str = "month"
    coarse: str | None = None
    path: str | None = None

    @property
    def order(self) -> str:
        return ", ".join([self.time, *self.ties])

    def local(self, frame: str = "") -> str:
        """Window text: time order inside one fine bucket."""
        return f"OVER (PARTITION BY {GROUP} ORDER BY {self.order} {frame})"

    def by(self, *keys: str) -> "Series":
        return replace(self, keys=tuple(keys))


HOURLY = Series()
EVENT_LOG = Series(keys=(), time="ts", ties=("event_id",), fine="second", coarse="day")
SO_FAR = "ROWS UNBOUNDED PRECEDING"
EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@dataclass(frozen=True)
class Carry:
    """One quantity handed from bucket to bucket: a per-bucket aggregate and how buckets combine.

    ``how`` is ``sum``, ``min`` or ``max``; the carried value covers all earlier buckets.
    """

    name: str
    aggregate: str
    how: str = "sum"

    def combined(self) -> str:
        return f"{self.how}({self.name})"

    def start(self, expr: str) -> str:
        """Nothing precedes the first bucket: a sum is then zero."""
        return f"coalesce({expr}, 0)" if self.how == "sum" else expr

    def merge(self, a: str, b: str) -> str:
        if self.how == "sum":
            return f"coalesce({a}, 0) + coalesce({b}, 0)"
        return f"{'least' if self.how == 'min' else 'greatest'}({a}, {b})"


def last_known(name: str, column: str, order: str) -> Carry:
    """Carry of the latest non-null value of ``column`` as struct (columns of the order, v)."""
    return Carry(name, f"max(CASE WHEN {column} IS NOT NULL THEN struct({order}, {column} AS v) END)", "max")


def first_known(name: str, column: str, order: str) -> Carry:
    return Carry(name, f"min(CASE WHEN {column} IS NOT NULL THEN struct({order}, {column} AS v) END)", "min")


def _window(keys: Sequence[str], order: str = "", frame: str = "") -> str:
    parts = [f"PARTITION BY {', '.join(keys)}" if keys else "", f"ORDER BY {order}" if order else "", frame]
    return f"OVER ({' '.join(p for p in parts if p)})"


def grouped(df: DataFrame, series: Series) -> DataFrame:
    """Add the group of every row: one struct of its keys and its bucket.

    Structs are equal where their nulls are, so rows without a key form a series of their own and rows without
    a time come last in theirs.
    """
    rows = df.selectExpr("*", f"date_trunc('{series.fine}', {series.time}) AS {BUCKET}")
    return rows.selectExpr("*", f"struct({', '.join([*series.keys, BUCKET, *bucket_path(series)])}) AS {GROUP}").drop(BUCKET)


def bucket_path(series: Series) -> list[str]:
    return [series.path] if series.path else []


def with_carry(df: DataFrame, series: Series, carries: list[Carry], totals: Sequence[Carry] = ()) -> DataFrame:
    """Add the group, every carry over earlier buckets, and every total over the whole series."""
    keys, every = list(series.keys), [*carries, *totals]
    rows = grouped(df, series)
    fine = rows.groupBy(GROUP).agg(*[F.expr(c.aggregate).alias(c.name) for c in every])
    fine = fine.selectExpr(GROUP, *[f"{GROUP}.{k} AS {k}" for k in [*keys, BUCKET, *bucket_path(series)]], *[c.name for c in every])
    whole = [f"{c.combined()} {_window(keys)} AS __all_{c.name}" for c in totals]
    in_order = ", ".join([f"{BUCKET} NULLS LAST", *bucket_path(series)])
    if series.coarse is None:
        before = _window(keys, in_order, EARLIER)
        carried = [f"{c.start(f'{c.combined()} {before}')} AS __far_{c.name}" for c in carries]
        table = fine.selectExpr(GROUP, *carried, *whole)
    else:
        wide = f"struct({', '.join([*keys, f"date_trunc('{series.coarse}', {BUCKET}) AS {COARSE}"])}) AS __wide"
        fine = fine.selectExpr("*", wide)
        coarse = fine.groupBy("__wide").agg(*[F.expr(c.combined()).alias(c.name) for c in every])
        far = _window([f"__wide.{k}" for k in keys], f"__wide.{COARSE} NULLS LAST", EARLIER)
        whole = [f"{c.combined()} {_window([f'__wide.{k}' for k in keys])} AS __all_{c.name}" for c in totals]
        coarse = coarse.selectExpr("__wide", *[f"{c.combined()} {far} AS __far_{c.name}" for c in carries], *whole)
        near = _window(["__wide"], in_order, EARLIER)
        fine = fine.selectExpr("__wide", GROUP, *[f"{c.combined()} {near} AS __near_{c.name}" for c in carries])
        table = fine.join(coarse, "__wide").selectExpr(
            GROUP,
            *[f"{c.merge(f'__far_{c.name}', f'__near_{c.name}')} AS __far_{c.name}" for c in carries],
            *[f"__all_{c.name}" for c in totals],
        )
    names = {f"__far_{c.name}": c.name for c in carries} | {f"__all_{c.name}": c.name for c in totals}
    return rows.join(table.withColumnsRenamed(names), GROUP)


def ordinal(df: DataFrame, series: Series, name: str = "position", size: str | None = None) -> DataFrame:
    """Zero-based row number in time order and, if asked for, the number of rows of the series."""
    totals = [Carry(size, "count(1)")] if size else []
    out = with_carry(df, series, [Carry("__before", "count(1)")], totals)
    extra = [size] if size else []
    return out.selectExpr(*df.columns, f"__before + row_number() {series.local()} - 1 AS {name}", *extra)


def running_total(df: DataFrame, series: Series, value: str, name: str) -> DataFrame:
    """Inclusive running sum of the expression ``value`` in time order."""
    rows = df.selectExpr("*", f"{value} AS __value")
    out = with_carry(rows, series, [Carry("__before", "sum(__value)")])
    return out.selectExpr(
        *df.columns, f"__before + coalesce(sum(__value) {series.local(SO_FAR)}, 0) AS {name}"
    )


def previous(df: DataFrame, series: Series, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Values of ``columns`` on the row before, across bucket borders."""
    values = f"struct({', '.join(f'{c} AS v_{c}' for c in columns)})"
    whole_row = Carry("__last", f"max(struct({series.order}, {values} AS v))", "max")
    out = with_carry(df, series, [whole_row])
    out = out.selectExpr("*", f"coalesce(lag({values}) {series.local()}, __last.v) AS __prev")
    return out.selectExpr(*df.columns, *[f"__prev.v_{c} AS {prefix}{c}" for c in columns])


def filled_value(c: str, series: Series) -> str:
    """Latest known value up to the row; needs the carry ``__last_<c>``."""
    return f"coalesce(last({c}, true) {series.local(SO_FAR)}, __last_{c}.v)"


def forward_fill(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Replace nulls with the latest earlier value; leading nulls stay."""
    out = with_carry(df, series, [last_known(f"__last_{c}", c, series.order) for c in columns])
    return out.selectExpr(*[f"{filled_value(c, series)} AS {c}" if c in columns else c for c in df.columns])


def forward_back_fill(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Forward fill, then give leading nulls the first value the series ever has."""
    carries = [last_known(f"__last_{c}", c, series.order) for c in columns]
    out = with_carry(df, series, carries, [first_known(f"__first_{c}", c, series.order) for c in columns])
    filled = {c: f"coalesce({filled_value(c, series)}, __first_{c}.v) AS {c}" for c in columns}
    return out.selectExpr(*[filled.get(c, c) for c in df.columns])
