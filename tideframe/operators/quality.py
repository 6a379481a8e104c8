"""Data-quality checks and the gate built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import hours_between, ieee_div, literal, quoted
from tideframe.functions.numeric import NUMERIC
from tideframe.plans.blocks import in_blocks
from tideframe.plans.ordered import HOURLY, Series
from tideframe.sources.tables import BASE_COLUMNS

# Limits of the checks.
MAX_NULL_PERCENTAGE = 1.0
MAX_CHANGE = 0.5
MAX_AGE_HOURS = 2
MIN_COMPLETENESS = 0.9
MIN_ROWS = 10


class DataQualityError(ValueError):
    """A critical check failed."""


def _null_count(c: str) -> str:
    return f"count_if({quoted(c)} IS NULL)"


def _percentage(part: str, whole: str = "count(1)") -> str:
    return f"coalesce(try_divide({part}, {whole}), 0D) * 100"


def _rows(df: DataFrame, structs: Sequence[str]) -> DataFrame:
    """One aggregation over ``df``, its results laid out as rows."""
    return df.agg(F.expr(f"array({', '.join(structs)})").alias("r")).selectExpr("inline(r)")


def null_check(
    df: DataFrame, columns: Sequence[str] | None = None, max_null_percentage: float = MAX_NULL_PERCENTAGE
) -> DataFrame:
    """Null count and percentage per column; ``failed`` if the percentage is above the limit."""
    return _rows(
        df,
        [
            f"struct({literal(c)} AS column_name, {_null_count(c)} AS null_count, {_percentage(_null_count(c))} AS null_percentage,"
            f" count(1) AS total_rows, {_percentage(_null_count(c))} > {max_null_percentage}D AS failed)"
            for c in (columns or df.columns)
        ],
    )


def schema_check(df: DataFrame, expected: Sequence[str] = BASE_COLUMNS) -> DataFrame:
    """Every expected or actual column with its status; ``rows`` says how many rows the status stands for."""
    actual = set(df.columns)
    names = sorted(actual | set(expected))
    status = {c: "missing" if c not in actual else "present" if c in expected else "extra" for c in names}
    return _rows(df, [f"struct({literal(c)} AS column_name, '{status[c]}' AS status, count(1) AS rows)" for c in names])


def type_check(df: DataFrame, numeric: Sequence[str] = BASE_COLUMNS, time: str = "timestamp") -> DataFrame:
    """Per column: cells that do not parse as the expected type. Text columns are tested cell by cell."""
    structs = []
    for c, expected, parse in [*[(c, "numeric", "try_cast({} AS DOUBLE)") for c in numeric], (time, "datetime", "try_to_timestamp({})")]:
        if c not in df.columns:
            continue
        data_type = df.schema[c].dataType
        typed = isinstance(data_type, NUMERIC) if expected == "numeric" else data_type.typeName().startswith("timestamp")
        text = data_type.typeName() == "string"
        bad = f"count_if({c} IS NOT NULL AND {parse.format(c)} IS NULL)" if text else "0L" if typed else f"count({c})"
        structs.append(f"struct('{c}' AS column_name, '{expected}' AS expected, {bad} AS bad_cells, {bad} = 0 AS valid)")
    return _rows(df, structs)


def _with_change(df: DataFrame, series: Series, **options) -> DataFrame:
    """Add ``__change``: absolute fractional price change against the row before, over filled prices."""
    return in_blocks(
        df,
        series,
        lambda p: {"__change": f"abs({ieee_div(p.filled('price'), p.filled_lag('price', 1))} - 1)"},
        fill=["price"],
        **options,
    )


RANGE_COUNTS = {
    "negative_prices": "count_if(price < 0)",
    "invalid_volumes": "count_if(total_volume <= 0)",
    "extreme_changes": f"count_if(__change > {MAX_CHANGE}D)",
}


def range_check(df: DataFrame, series: Series = HOURLY, **options) -> DataFrame:
    """Per series: negative prices, non-positive volumes, price jumps above 50 %."""
    counts = _with_change(df, series, **options).groupBy(*series.keys)
    counts = counts.agg(*[F.expr(e).alias(n) for n, e in RANGE_COUNTS.items()])
    return counts.selectExpr("*", f"{' + '.join(RANGE_COUNTS)} = 0 AS ranges_valid")


def freshness_check(
    df: DataFrame, series: Series = HOURLY, as_of: str | None = None, max_age_hours: float = MAX_AGE_HOURS
) -> DataFrame:
    """Per series: age of the latest row at ``as_of`` (now if not given)."""
    now = f"TIMESTAMP '{as_of}'" if as_of else "current_timestamp()"
    latest = df.groupBy(*series.keys).agg(F.max(series.time).alias("latest_timestamp"))
    return latest.selectExpr("*", f"{hours_between(now, 'latest_timestamp')} AS age_hours").selectExpr(
        "*", f"age_hours <= {float(max_age_hours)}D AS fresh"
    )


def completeness_check(df: DataFrame, series: Series = HOURLY) -> DataFrame:
    """Per series: rows against the rows an unbroken hourly grid would have."""
    span = hours_between(f"max({series.time})", f"min({series.time})")
    counts = df.groupBy(*series.keys).agg(
        F.expr(f"CAST({span} AS BIGINT) + 1").alias("expected_records"), F.count(F.lit(1)).alias("actual_records")
    )
    counts = counts.selectExpr("*", "try_divide(actual_records, expected_records) AS completeness_ratio")
    return counts.selectExpr("*", f"completeness_ratio >= {MIN_COMPLETENESS}D AS complete")


def quality_report(
    df: DataFrame,
    series: Series = HOURLY,
    as_of: str | None = None,
    max_null_percentage: float = MAX_NULL_PERCENTAGE,
    **options,
) -> DataFrame:
    """One report row per series. The overall status rests on nulls, schema, types and ranges only."""
    columns = [c for c in df.columns if c not in {*series.keys, series.time}]
    missing = [c for c in BASE_COLUMNS if c not in df.columns]
    wrong = [c for c in BASE_COLUMNS if c in df.columns and not isinstance(df.schema[c].dataType, NUMERIC)]
    now = f"TIMESTAMP '{as_of}'" if as_of else "current_timestamp()"
    span = hours_between(f"max({series.time})", f"min({series.time})")
    measures = {
        "rows": "count(1)",
        "latest_timestamp": f"max({series.time})",
        "expected_records": f"CAST({span} AS BIGINT) + 1",
        **RANGE_COUNTS,
        **{f"__null_{c}": _percentage(_null_count(c)) for c in columns},
    }
    one = _with_change(df, series, **options).groupBy(*series.keys).agg(*[F.expr(e).alias(n) for n, e in measures.items()])
    failed = ", ".join(f"CASE WHEN {quoted(f'__null_{c}')} > {max_null_percentage}D THEN {literal(c)} END" for c in columns)
    one = one.selectExpr(
        *series.keys,
        "rows",
        f"concat_ws(',', {failed}) AS failed_columns",
        f"{'true' if not missing else 'false'} AS schema_valid",
        f"{'true' if not wrong else 'false'} AS types_valid",
        *RANGE_COUNTS,
        f"{' + '.join(RANGE_COUNTS)} = 0 AS ranges_valid",
        f"{hours_between(now, 'latest_timestamp')} AS age_hours",
        f"{hours_between(now, 'latest_timestamp')} <= {MAX_AGE_HOURS} AS fresh",
        "try_divide(rows, expected_records) AS completeness_ratio",
        f"try_divide(rows, expected_records) >= {MIN_COMPLETENESS}D AS complete",
    )
    passed = "failed_columns = '' AND schema_valid AND types_valid AND ranges_valid"
    return one.selectExpr("*", f"CASE WHEN {passed} THEN 'PASSED' ELSE 'FAILED' END AS overall_status")


def enforce_quality(df: DataFrame, expected: Sequence[str] = BASE_COLUMNS, max_null_percentage: float = MAX_NULL_PERCENTAGE) -> None:
    """Raise for the two critical checks, nulls first, then missing columns."""
    failed = {r["column_name"]: r["null_percentage"] for r in null_check(df, None, max_null_percentage).where("failed").collect()}
    if failed:
        raise DataQualityError(f"null percentage above {max_null_percentage}%: {failed}")
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise DataQualityError(f"missing required columns: {missing}")


def check_file(spark, path: str, max_null_percentage: float = MAX_NULL_PERCENTAGE, **options) -> DataFrame:
    """Report of one stored CSV series; raises for the two critical checks, and if there is no file."""
    from tideframe.sources.files import read_series_csv

    rows = read_series_csv(spark, path)
    enforce_quality(rows, BASE_COLUMNS, max_null_percentage)
    return quality_report(rows, Series(keys=()), max_null_percentage=max_null_percentage, **options)


def quality_gate(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS, min_rows: int = MIN_ROWS) -> DataFrame:
    """The mandatory gate as rows (check, column, value, passed); the gate passes if every row does."""
    structs = []
    for c in columns:
        present = c in df.columns
        structs.append(_gate_row("schema", c, "1D" if present else "0D", "true" if present else "false"))
        if present:
            share = _percentage(_null_count(c))
            structs.append(_gate_row("nulls", c, share, f"{share} <= {MAX_NULL_PERCENTAGE}D"))
            typed = isinstance(df.schema[c].dataType, NUMERIC)
            bad = "0" if typed else f"count_if({c} IS NOT NULL AND try_cast({c} AS DOUBLE) IS NULL)"
            structs.append(_gate_row("numeric", c, bad, f"{bad} = 0"))
    structs.append(_gate_row("rows", "", "count(1)", f"count(1) >= {min_rows}"))
    return _rows(df, structs)


def _gate_row(check: str, column: str, value: str, passed: str) -> str:
    return f"struct('{check}' AS check_name, '{column}' AS column_name, CAST({value} AS DOUBLE) AS value, {passed} AS passed)"


def enforce_gate(df: DataFrame, columns: Sequence[str] = BASE_COLUMNS) -> None:
    """Raise once, with every issue found."""
    issues = [f"{r['check_name']} {r['column_name']}: {r['value']}" for r in quality_gate(df, columns).where("NOT passed").collect()]
    if issues:
        raise DataQualityError(f"data quality gate failed: {issues}")
