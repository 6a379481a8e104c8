"""Windowed features for hourly series.

Two feature sets exist that share column names but not meanings: the *full* set (123 columns) and
the *compact* set (62 columns). Keep to one of them from training to scoring. Window sizes count
rows, never hours of wall time, and a rolling value exists only once its window is full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tideframe.functions.expressions import cyclic, hours_between, ieee_div
from tideframe.functions.numeric import null_safe_doubles
from tideframe.plans.blocks import START, Columns, in_blocks
from tideframe.plans.ordered import HOURLY, Series, previous
from tideframe.sources.tables import BASE_COLUMNS

# Column sets and window sizes of the two feature sets.
LAGS = (1, 3, 6, 12, 24)
WINDOWS = (3, 6, 12, 24, 48)
COMPACT_WINDOWS = (3, 6, 12, 24)
BOLLINGER_ROWS, COMPACT_BOLLINGER_ROWS = 20, 12

Outputs = dict[str, str]


def calendar_columns(time: str, wide: bool = True) -> Outputs:
    """Calendar parts (Monday is day 0) and their positions on the circle."""
    hour, weekday, month = f"hour({time})", f"weekday({time})", f"month({time})"
    out: Outputs = {"hour": hour}
    if wide:
        out["day"] = f"dayofmonth({time})"
    out["day_of_week"] = weekday
    if wide:
        out |= {"month": month, "quarter": f"quarter({time})", "year": f"year({time})"}
    circles = [("hour", hour, 24), ("day", weekday, 7)] + ([("month", month, 12)] if wide else [])
    for label, value, period in circles:
        out[f"{label}_sin"], out[f"{label}_cos"] = cyclic(value, period)
    return out


def _temporal(p: Columns) -> Outputs:
    return calendar_columns(p.series.time) | {"hours_since_start": hours_between(p.series.time, START)}


def _lags(p: Columns, columns: Sequence[str], lags: Sequence[int], names: dict[str, str] | None = None) -> Outputs:
    names = names or {}
    return {f"{names.get(c, c)}_lag_{k}h": p.lag(c, k) for c in columns if c in p.available for k in lags}


def _rolling(p: Columns, columns: Sequence[str], windows: Sequence[int]) -> Outputs:
    out: Outputs = {}
    for c in (c for c in columns if c in p.available):
        for rows in windows:
            for label, make in (("mean", p.mean), ("std", p.std), ("min", p.low), ("max", p.high)):
                out[f"{c}_rolling_{label}_{rows}h"] = make(c, rows)
    return out


def _fraction_change(p: Columns, c: str, rows: int) -> str:
    """Change against the value ``rows`` rows before as a fraction, over gap-filled values."""
    return f"{ieee_div(p.filled(c), p.filled_lag(c, rows))} - 1"


def _hourly_return(p: Columns) -> str:
    needs = [p.filled("price"), p.filled_lag("price", 1)]
    return p.add("__return", _fraction_change(p, "price", 1), needs)


def _price_change(p: Columns) -> Outputs:
    if "price" not in p.available:
        return {}
    out: Outputs = {f"price_change_{k}h": f"price - {p.lag('price', k)}" for k in (1, 3, 6, 24)}
    out |= {f"price_pct_change_{k}h": _fraction_change(p, "price", k) for k in (1, 3, 6, 24)}
    out |= {f"volatility_{k}h": p.std(_hourly_return(p), k) for k in (6, 24)}
    out |= {f"momentum_{k}h": f"{ieee_div('price', p.lag('price', k))} - 1" for k in (6, 24)}
    low, high = p.low("price", 24), p.high("price", 24)
    out["price_position_24h"] = ieee_div(f"price - {low}", f"{high} - {low}")
    return out


def _volume(p: Columns) -> Outputs:
    if "total_volume" not in p.available:
        return {}
    volume = "total_volume"
    out: Outputs = {f"volume_change_{k}h": _fraction_change(p, volume, k) for k in (1, 6, 24)}
    out |= {f"volume_ma_{k}h": p.mean(volume, k) for k in (6, 24)}
    out |= {f"volume_ratio_{k}h": ieee_div(volume, p.mean(volume, k)) for k in (6, 24)}
    if "price" in p.available:
        out["price_volume_corr_24h"] = p.correlation("price", volume, 24)
    return out


def _ewma(p: Columns, column: str, spans: Sequence[int], prefix: str = "ema") -> Outputs:
    out = {f"{prefix}_{str(span).replace('.', '_')}h": p.ewma(column, span) for span in spans} if column in p.available else {}
    p.carried += out
    return out


def _bands(p: Columns, rows: int) -> tuple[str, str, str]:
    """Middle, upper and lower band: mean and two sample deviations around it."""
    middle, spread = p.mean("price", rows), f"2 * {p.std('price', rows)}"
    return middle, f"({middle} + {spread})", f"({middle} - {spread})"


def _technical(p: Columns) -> Outputs:
    if "price" not in p.available:
        return {}
    out: Outputs = {f"sma_{k}h": p.mean("price", k) for k in (6, 12, 24)}
    out |= _ewma(p, "price", (6, 12, 24))
    _, upper, lower = _bands(p, BOLLINGER_ROWS)
    out |= {"bollinger_upper": upper, "bollinger_lower": lower, "bollinger_width": f"{upper} - {lower}"}
    for k in (6, 24):
        out[f"price_above_sma_{k}h"] = f"CAST(coalesce(price > {p.mean('price', k)}, false) AS INT)"
    return out


def _compact(p: Columns) -> Outputs:
    """Every column of the compact set; change columns are fractions, momentum is a difference."""
    volume = "total_volume"
    out = calendar_columns(p.series.time, wide=False)
    out |= _lags(p, ["price", volume], LAGS, names={volume: "volume"})
    for rows in COMPACT_WINDOWS:
        out |= _rolling(p, ["price"], [rows])
        out[f"volume_rolling_mean_{rows}h"] = p.mean(volume, rows)
    out |= {f"price_change_{k}h": _fraction_change(p, "price", k) for k in LAGS}
    out |= {f"momentum_{k}h": f"price - {p.lag('price', k)}" for k in (3, 6, 12)}
    out |= {f"volatility_{k}h": p.std(_hourly_return(p), k) for k in (6, 12, 24)}
    out["volume_price_ratio"] = ieee_div(volume, "price")
    out["volume_change_1h"] = _fraction_change(p, volume, 1)
    out |= {f"sma_{k}h": p.mean("price", k) for k in (6, 12, 24)}
    out |= _ewma(p, "price", (6, 12))
    middle, upper, lower = _bands(p, COMPACT_BOLLINGER_ROWS)
    out |= {"bb_middle": middle, "bb_upper": upper, "bb_lower": lower}
    out["bb_width"] = ieee_div(f"{upper} - {lower}", middle)
    out["price_bb_position"] = ieee_div(f"price - {lower}", f"{upper} - {lower}")
    return out


def add_temporal_features(df: DataFrame, series: Series = HOURLY, **options) -> DataFrame:
    """Calendar parts, their circles, and hours since the first row of the series."""
    return in_blocks(df, series, _temporal, **options)


def add_lag_features(
    df: DataFrame, series: Series = HOURLY, columns: Sequence[str] = BASE_COLUMNS, lags: Sequence[int] = LAGS, **options
) -> DataFrame:
    """``<column>_lag_<k>h``: the value k rows before."""
    return in_blocks(df, series, lambda p: _lags(p, columns, lags), **options)


def add_rolling_features(
    df: DataFrame,
    series: Series = HOURLY,
    columns: Sequence[str] = BASE_COLUMNS,
    windows: Sequence[int] = WINDOWS,
    **options,
) -> DataFrame:
    """Mean, sample deviation, minimum and maximum over the last W rows."""
    return in_blocks(df, series, lambda p: _rolling(p, columns, windows), **options)


def add_price_change_features(df: DataFrame, series: Series = HOURLY, **options) -> DataFrame:
    """Differences, fractional changes, volatility, momentum and position in the day's range."""
    return in_blocks(df, series, _price_change, fill=[c for c in ["price"] if c in df.columns], **options)


def add_volume_features(df: DataFrame, series: Series = HOURLY, **options) -> DataFrame:
    """Volume changes, averages, ratios and price-volume correlation."""
    return in_blocks(df, series, _volume, fill=[c for c in ["total_volume"] if c in df.columns], **options)


def add_technical_indicators(df: DataFrame, series: Series = HOURLY, **options) -> DataFrame:
    """Moving averages, Bollinger bands and above-average flags."""
    return in_blocks(df, series, _technical, **options)


def add_ewma_features(
    df: DataFrame, series: Series = HOURLY, column: str = "price", spans: Sequence[int] = (6, 12, 24), **options
) -> DataFrame:
    """Adjusted exponential means; a missing value ages the weights of the values before it and repeats the last mean."""
    return in_blocks(df, series, lambda p: _ewma(p, column, spans, f"{column}_ewma"), **options)


def _full(p: Columns) -> Outputs:
    out = _temporal(p) | _lags(p, BASE_COLUMNS, LAGS) | _rolling(p, BASE_COLUMNS, WINDOWS)
    return out | _price_change(p) | _volume(p) | _technical(p)


def full_features(raw: DataFrame, series: Series = HOURLY, order: str | None = "ingest_seq", **options) -> DataFrame:
    """Raw series to the full feature set: clean, build every group, keep complete rows.

    Cleaning (first delivery wins, forward fill, drop leading gaps) shares the pass that numbers rows.
    """
    from tideframe.operators.clean import dedupe_first

    raw = null_safe_doubles(raw)
    rows = dedupe_first(raw, series, order) if order and order in raw.columns else raw
    rows = rows.select(*series.keys, series.time, *BASE_COLUMNS)
    return in_blocks(rows, series, _full, clean=BASE_COLUMNS, drop_incomplete=True, **options)


def compact_features(
    raw: DataFrame, series: Series = HOURLY, order: str | None = "ingest_seq", keep: Sequence[str] = (), **options
) -> DataFrame:
    """Raw series to the compact feature set: drop incomplete rows, first delivery wins, no filling.

    ``keep`` names further input columns to hand through.
    """
    from tideframe.operators.clean import clean_series_strict

    rows = clean_series_strict(null_safe_doubles(raw), series, order)
    rows = rows.select(*series.keys, series.time, *BASE_COLUMNS, *keep)
    return in_blocks(rows, series, _compact, drop_incomplete=True, **options)


def previous_row(df: DataFrame, columns: list[str], series: Series = HOURLY, prefix: str = "prev_") -> DataFrame:
    """Values of the row before, as ``prev_<column>``."""
    return previous(df, series, columns, prefix)
