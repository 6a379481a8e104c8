"""Independent SQL for the registered queries, written for a single-node SQL engine.

The statements restate the semantics with plain windows, self-joins and exact quantiles; none of the
block, carry or slot techniques of the engine appears here.
"""

from __future__ import annotations


# Histogram bounds, stated here again so that a wrong bound in the engine shows.
REQUEST_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PREDICTION_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
from tideframe.sources.tables import BASE_COLUMNS

ORACLE: dict[str, str] = {}

HOURLY = """
hourly AS (
  SELECT event_type AS coin_id, date_trunc('hour', ts)::TIMESTAMP AS timestamp,
         last(value ORDER BY ts, event_id) AS price,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS market_cap,
         CAST(count(*) AS DOUBLE) AS total_volume
  FROM events GROUP BY 1, 2)"""
DIRTY = (
    HOURLY
    + """,
base AS (
  SELECT coin_id, timestamp,
         CASE WHEN hour(timestamp) % 7 <> 0 THEN price END AS price,
         CASE WHEN (day(timestamp) + hour(timestamp)) % 5 <> 0 THEN market_cap END AS market_cap,
         CASE WHEN hour(timestamp) % 9 <> 4 THEN total_volume END AS total_volume,
         CAST((day(timestamp) * 37 + hour(timestamp) * 11) % 101 * 10 AS BIGINT) AS ingest_seq
  FROM hourly),
dirty AS (
  SELECT * FROM base
  UNION ALL SELECT coin_id, timestamp, price + 1, market_cap, total_volume, ingest_seq + 1 FROM base WHERE hour(timestamp) % 6 = 1
  UNION ALL SELECT coin_id, timestamp, price - 1, market_cap, total_volume, ingest_seq - 1 FROM base WHERE hour(timestamp) % 11 = 5)"""
)
DEDUPED = (
    DIRTY
    + """,
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, timestamp ORDER BY ingest_seq) AS rn FROM dirty) WHERE rn = 1)"""
)
_LAST = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY coin_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS {c}" for c in BASE_COLUMNS
)
FILLED = DEDUPED + f", filled AS (SELECT coin_id, timestamp, {_LAST}, ingest_seq FROM deduped)"
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in BASE_COLUMNS)
CLEAN = FILLED + f", clean AS (SELECT * FROM filled WHERE {COMPLETE})"
STRICT = (
    DIRTY
    + f""",
strict AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, timestamp ORDER BY ingest_seq) AS rn FROM dirty WHERE {COMPLETE})
  WHERE rn = 1)"""
)
LOG = """
log AS (
  SELECT event_id, ts, event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         value / 100.0 AS latency_s, 'm' || CAST(user_id % 3 AS VARCHAR) AS model_type,
         ts + to_microseconds(CAST(round(value * 10000) AS BIGINT)) AS end_ts
  FROM events)"""


def rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0 AS {c}" for c in columns)


def oracle(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = f"WITH {ctes.strip()} {body}"


def div(a: str, b: str) -> str:
    return (
        f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN 'inf'::DOUBLE WHEN ({a}) < 0 THEN '-inf'::DOUBLE END"
        f" ELSE ({a}) / ({b}) END"
    )


# sources, filters, cleaning --------------------------------------------------------------------

BASE = "coin_id, timestamp, " + rounded(*BASE_COLUMNS)
for _name in ("market_chart_flatten", "csv_roundtrip"):
    oracle(_name, HOURLY, f"SELECT {BASE} FROM hourly")
oracle("latest_version", HOURLY, f"SELECT {BASE} FROM hourly WHERE timestamp < TIMESTAMP '2024-01-30'")
oracle(
    "time_range_filter",
    HOURLY,
    f"SELECT {BASE} FROM hourly WHERE timestamp >= TIMESTAMP '2024-01-10' AND timestamp <= TIMESTAMP '2024-01-20 12:00:00'",
)
for _name, _edge in (("latest_row", "max"), ("first_row", "min")):
    oracle(
        _name,
        HOURLY,
        f"SELECT {BASE} FROM hourly h WHERE timestamp = (SELECT {_edge}(timestamp) FROM hourly g WHERE g.coin_id = h.coin_id)",
    )
SEQ = BASE + ", ingest_seq"
oracle("dropna_rows", DIRTY, f"SELECT {SEQ} FROM dirty WHERE {COMPLETE}")
oracle("dedupe_first", DEDUPED, f"SELECT {SEQ} FROM deduped")
oracle("ffill", FILLED, f"SELECT {SEQ} FROM filled")
_BOTH = ", ".join(
    f"coalesce({c}, (SELECT arg_min(d.{c}, d.timestamp) FROM deduped d WHERE d.coin_id = f.coin_id AND d.{c} IS NOT NULL)) AS {c}"
    for c in BASE_COLUMNS
)
oracle(
    "ffill_bfill", FILLED, f"SELECT {SEQ} FROM (SELECT coin_id, timestamp, {_BOTH}, ingest_seq FROM filled f)"
)
oracle("clean_series", CLEAN, f"SELECT {SEQ} FROM clean")
oracle("clean_series_strict", STRICT, f"SELECT {SEQ} FROM strict")
_IMPUTE = (
    DIRTY
    + ", broken AS (SELECT * REPLACE (CASE WHEN hour(timestamp) = 3 THEN 'inf'::DOUBLE ELSE price END AS price) FROM dirty)"
    + ", first_pass AS (SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM broken)) AS {c}" for c in BASE_COLUMNS)
    + ") FROM broken), finite AS (SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END AS {c}" for c in BASE_COLUMNS)
    + ") FROM first_pass), second_pass AS (SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM finite)) AS {c}" for c in BASE_COLUMNS)
    + ") FROM finite)"
)
oracle("median_impute", _IMPUTE, f"SELECT {SEQ} FROM second_pass")


# features --------------------------------------------------------------------------------------

W = "PARTITION BY coin_id ORDER BY timestamp"


def lag(c: str, k: int) -> str:
    return f"lag({c}, {k}) OVER ({W})"


def roll(f: str, c: str, n: int) -> str:
    frame = f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {frame} = {n} THEN {f}({c}) {frame} END"


def pct(c: str, k: int) -> str:
    return div(c, lag(c, k)) + " - 1"


ROLLS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def calendar(wide: bool) -> dict[str, str]:
    t = "timestamp"
    out = {"hour": f"CAST(hour({t}) AS INTEGER)"}
    if wide:
        out["day"] = f"CAST(day({t}) AS INTEGER)"
    out["day_of_week"] = f"CAST(isodow({t}) - 1 AS INTEGER)"
    if wide:
        out |= {p: f"CAST({p}({t}) AS INTEGER)" for p in ("month", "quarter", "year")}
    circles = [("hour", f"hour({t})", 24), ("day", f"(isodow({t}) - 1)", 7)] + ([("month", f"month({t})", 12)] if wide else [])
    for label, value, period in circles:
        out[f"{label}_sin"] = f"sin(2 * pi() * {value} / {period})"
        out[f"{label}_cos"] = f"cos(2 * pi() * {value} / {period})"
    return out


TEMPORAL = calendar(True) | {
    "hours_since_start": "(epoch_us(timestamp) - epoch_us(min(timestamp) OVER (PARTITION BY coin_id))) / 3600000000.0"
}
LAGS = {f"{c}_lag_{k}h": lag(c, k) for c in BASE_COLUMNS for k in (1, 3, 6, 12, 24)}
ROLLING = {
    f"{c}_rolling_{label}_{n}h": roll(f, c, n) for c in BASE_COLUMNS for n in (3, 6, 12, 24, 48) for label, f in ROLLS.items()
}
PRICE = (
    {f"price_change_{k}h": f"price - {lag('price', k)}" for k in (1, 3, 6, 24)}
    | {f"price_pct_change_{k}h": pct("price", k) for k in (1, 3, 6, 24)}
    | {f"volatility_{n}h": roll("stddev_samp", "ret", n) for n in (6, 24)}
    | {f"momentum_{k}h": pct("price", k) for k in (6, 24)}
    | {
        "price_position_24h": div(
            f"price - {roll('min', 'price', 24)}", f"{roll('max', 'price', 24)} - {roll('min', 'price', 24)}"
        )
    }
)
VOLUME = (
    {f"volume_change_{k}h": pct("total_volume", k) for k in (1, 6, 24)}
    | {f"volume_ma_{n}h": roll("avg", "total_volume", n) for n in (6, 24)}
    | {f"volume_ratio_{n}h": div("total_volume", roll("avg", "total_volume", n)) for n in (6, 24)}
    | {
        "price_volume_corr_24h": "CASE WHEN " + roll("count", "price", 24) + " = 24 AND "
        + roll("stddev_samp", "price", 24) + " > 0 AND " + roll("stddev_samp", "total_volume", 24) + " > 0 THEN "
        + f"corr(price, total_volume) OVER ({W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END"
    }
)


def bands(n: int) -> tuple[str, str, str]:
    m, s = roll("avg", "price", n), roll("stddev_samp", "price", n)
    return m, f"({m} + 2 * {s})", f"({m} - 2 * {s})"


_, UPPER, LOWER = bands(20)
TECHNICAL = (
    {f"sma_{n}h": roll("avg", "price", n) for n in (6, 12, 24)}
    | {f"ema_{n}h": f"ema_{n}h" for n in (6, 12, 24)}
    | {"bollinger_upper": UPPER, "bollinger_lower": LOWER, "bollinger_width": f"{UPPER} - {LOWER}"}
    | {f"price_above_sma_{n}h": f"CAST(coalesce(price > {roll('avg', 'price', n)}, false) AS INTEGER)" for n in (6, 24)}
)
MIDDLE, C_UPPER, C_LOWER = bands(12)
COMPACT = (
    calendar(False)
    | {f"{v}_lag_{k}h": lag(c, k) for v, c in (("price", "price"), ("volume", "total_volume")) for k in (1, 3, 6, 12, 24)}
    | {f"price_rolling_{label}_{n}h": roll(f, "price", n) for n in (3, 6, 12, 24) for label, f in ROLLS.items()}
    | {f"volume_rolling_mean_{n}h": roll("avg", "total_volume", n) for n in (3, 6, 12, 24)}
    | {f"price_change_{k}h": pct("price", k) for k in (1, 3, 6, 12, 24)}
    | {f"momentum_{k}h": f"price - {lag('price', k)}" for k in (3, 6, 12)}
    | {f"volatility_{n}h": roll("stddev_samp", "ret", n) for n in (6, 12, 24)}
    | {"volume_price_ratio": div("total_volume", "price"), "volume_change_1h": pct("total_volume", 1)}
    | {f"sma_{n}h": roll("avg", "price", n) for n in (6, 12, 24)}
    | {f"ema_{n}h": f"ema_{n}h" for n in (6, 12)}
    | {"bb_middle": MIDDLE, "bb_upper": C_UPPER, "bb_lower": C_LOWER, "bb_width": div(f"{C_UPPER} - {C_LOWER}", MIDDLE)}
    | {"price_bb_position": div(f"price - {C_LOWER}", f"{C_UPPER} - {C_LOWER}")}
)
INTEGERS = {"hour", "day", "day_of_week", "month", "quarter", "year", "price_above_sma_6h", "price_above_sma_24h"}


def with_ewma(source: str, column: str, prefix: str, spans: tuple[int, ...]) -> str:
    """``ewma`` relation: every row joined with all rows before it, weights by distance in rows."""
    sums = ", ".join(
        f"sum(b.{column} * pow(1 - 2.0 / ({n} + 1), a.rn - b.rn)) / sum(CASE WHEN b.{column} IS NOT NULL THEN"
        f" pow(1 - 2.0 / ({n} + 1), a.rn - b.rn) END) AS {prefix}_{n}h"
        for n in spans
    )
    numbered = f"(SELECT *, row_number() OVER ({W}) AS rn FROM {source})"
    return (
        f"ewma AS (SELECT a.coin_id, a.timestamp, {sums} FROM {numbered} a JOIN {numbered} b"
        f" ON a.coin_id = b.coin_id AND b.rn <= a.rn GROUP BY 1, 2)"
    )


def featured(ctes: str, source: str, columns: dict[str, str], complete: bool = False, ewma: tuple[int, ...] = ()) -> tuple[str, str]:
    """CTEs and select list of a feature relation named ``featured``; rounding happens outside."""
    if ewma:
        ctes += ", " + with_ewma(source, "price", "ema", ewma)
        joined = f"(SELECT s.*, e.* EXCLUDE (coin_id, timestamp) FROM {source} s JOIN ewma e USING (coin_id, timestamp))"
    else:
        joined = source
    ctes += f", rows0 AS (SELECT *, {pct('price', 1)} AS ret FROM {joined} s)"
    cols = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    ctes += f", featured0 AS (SELECT coin_id, timestamp, {', '.join(BASE_COLUMNS)}, {cols} FROM rows0)"
    keep = " WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in columns) if complete else ""
    ctes += f", featured AS (SELECT * FROM featured0{keep})"
    out = [n if n in INTEGERS else rounded(n) for n in columns]
    return ctes, f"SELECT {BASE}, {', '.join(out)} FROM featured"


for _name, _columns, _ewma in (
    ("temporal_features", TEMPORAL, ()),
    ("lag_features", LAGS, ()),
    ("rolling_features", ROLLING, ()),
    ("price_change_features", PRICE, ()),
    ("volume_features", VOLUME, ()),
    ("technical_indicators", TECHNICAL, (6, 12, 24)),
):
    oracle(_name, *featured(HOURLY, "hourly", _columns, ewma=_ewma))
oracle(
    "ewma_features",
    DEDUPED + ", " + with_ewma("deduped", "price", "price_ewma", (6, 12, 24)),
    f"SELECT {BASE}, {rounded(*[f'price_ewma_{n}h' for n in (6, 12, 24)])} FROM deduped JOIN ewma USING (coin_id, timestamp)",
)
FULL = TEMPORAL | LAGS | ROLLING | PRICE | VOLUME | TECHNICAL
oracle("features_full", *featured(CLEAN, "clean", FULL, complete=True, ewma=(6, 12, 24)))
oracle("features_compact", *featured(STRICT, "strict", COMPACT, complete=True, ewma=(6, 12)))
_CTES, _ = featured(HOURLY, "hourly", TEMPORAL)
_PICKED = [n if n in INTEGERS else rounded(n) for n in TEMPORAL]
oracle("feature_select", _CTES, f"SELECT {BASE}, {', '.join(_PICKED)} FROM featured")
COMPACT_ROWS, _ = featured(HOURLY, "hourly", COMPACT, complete=True, ewma=(6, 12))
NUMERIC = [*BASE_COLUMNS, *COMPACT]

# quality ---------------------------------------------------------------------------------------


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


oracle(
    "null_check",
    DIRTY,
    f"SELECT column_name, null_count, {rounded('null_percentage')}, total_rows, null_percentage > 1.0 AS failed FROM ("
    + union(
        [
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
            f" (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_percentage, count(*) AS total_rows FROM dirty"
            for c in ["coin_id", "timestamp", *BASE_COLUMNS, "ingest_seq"]
        ]
    )
    + ")",
)
_STATUS = {"coin_id": "extra", "timestamp": "extra", "price": "present", "total_volume": "present", "market_cap": "missing"}
oracle(
    "schema_check",
    HOURLY,
    union([f"SELECT '{c}' AS column_name, '{s}' AS status, count(*) AS rows FROM hourly" for c, s in _STATUS.items()]),
)
oracle(
    "type_check",
    HOURLY,
    "SELECT column_name, expected, bad_cells, bad_cells = 0 AS valid FROM ("
    " SELECT 'price' AS column_name, 'numeric' AS expected, count(*) FILTER (hour(timestamp) = 5) AS bad_cells FROM hourly"
    " UNION ALL SELECT c, 'numeric', 0 FROM (VALUES ('market_cap'), ('total_volume')) t(c)"
    " UNION ALL SELECT 'timestamp', 'datetime', 0)",
)


def changes(source: str) -> str:
    fill = f"last_value(price IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING)"
    return (
        f", carried AS (SELECT *, {fill} AS carried_price FROM {source})"
        f", changed AS (SELECT *, abs({pct('carried_price', 1)}) AS change FROM carried)"
    )


_RANGES = (
    "count(*) FILTER (price < 0) AS negative_prices, count(*) FILTER (total_volume <= 0) AS invalid_volumes,"
    " count(*) FILTER (change > 0.5) AS extreme_changes"
)
oracle(
    "range_check",
    HOURLY + changes("hourly"),
    "SELECT *, negative_prices + invalid_volumes + extreme_changes = 0 AS ranges_valid FROM"
    f" (SELECT coin_id, {_RANGES} FROM changed GROUP BY 1)",
)
_AGE = "(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(timestamp))) / 3600000000.0"
_EXPECTED = "CAST(floor((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 3600000000.0) AS BIGINT) + 1"
oracle(
    "freshness_check",
    HOURLY,
    f"SELECT coin_id, latest_timestamp, {rounded('age_hours')}, age_hours <= 2 AS fresh FROM"
    f" (SELECT coin_id, max(timestamp) AS latest_timestamp, {_AGE} AS age_hours FROM hourly GROUP BY 1)",
)
oracle(
    "completeness_check",
    HOURLY,
    f"SELECT coin_id, expected_records, actual_records, {rounded('completeness_ratio')}, completeness_ratio >= 0.9 AS complete FROM"
    " (SELECT *, actual_records::DOUBLE / expected_records AS completeness_ratio FROM"
    f" (SELECT coin_id, {_EXPECTED} AS expected_records, count(*) AS actual_records FROM hourly GROUP BY 1))",
)
_FAILED = ", ".join(f"CASE WHEN (count(*) - count({c})) * 100.0 / count(*) > 1 THEN '{c}' END" for c in BASE_COLUMNS)
oracle(
    "quality_report",
    DEDUPED + changes("deduped"),
    "SELECT coin_id, rows, failed_columns, true AS schema_valid, true AS types_valid, negative_prices, invalid_volumes,"
    f" extreme_changes, ranges_valid, {rounded('age_hours')}, age_hours <= 2 AS fresh, {rounded('completeness_ratio')},"
    " completeness_ratio >= 0.9 AS complete,"
    " CASE WHEN failed_columns = '' AND ranges_valid THEN 'PASSED' ELSE 'FAILED' END AS overall_status FROM ("
    "SELECT *, negative_prices + invalid_volumes + extreme_changes = 0 AS ranges_valid,"
    " rows::DOUBLE / expected_records AS completeness_ratio FROM ("
    f"SELECT coin_id, count(*) AS rows, concat_ws(',', {_FAILED}) AS failed_columns, {_RANGES}, {_AGE} AS age_hours,"
    f" {_EXPECTED} AS expected_records FROM changed GROUP BY 1))",
)
oracle(
    "quality_gate",
    DIRTY,
    "SELECT check_name, column_name, round(value, 6) + 0 AS value, passed FROM ("
    + union(
        [f"SELECT 'schema' AS check_name, '{c}' AS column_name, 1.0::DOUBLE AS value, true AS passed" for c in BASE_COLUMNS]
        + [
            f"SELECT 'nulls', '{c}', (count(*) - count({c})) * 100.0::DOUBLE / count(*), (count(*) - count({c})) * 100.0 / count(*) <= 1 FROM dirty"
            for c in BASE_COLUMNS
        ]
        + [f"SELECT 'numeric', '{c}', 0.0::DOUBLE, true" for c in BASE_COLUMNS]
        + ["SELECT 'rows', '', count(*)::DOUBLE, count(*) >= 10 FROM dirty"]
    )
    + ")",
)

# profiles --------------------------------------------------------------------------------------

DELIVERIES = DIRTY + ", deliveries AS (SELECT * EXCLUDE (ingest_seq) FROM dirty)"


def stats(source: str, columns: list[str], label: str, counted: bool) -> str:
    count = "count({c}) AS count, " if counted else ""
    names = ["mean", "std", "min", "q25", "median", "q75", "max"]
    inner = union(
        [
            f"SELECT '{c}' AS {label}, {count.format(c=c)}avg({c})::DOUBLE AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min,"
            f" quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS median,"
            f" quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM {source}"
            for c in columns
        ]
    )
    head = f"{label}, count" if counted else label
    return f"SELECT {head}, {rounded(*names)} FROM ({inner})"


oracle("describe_stats", DELIVERIES, stats("deliveries", BASE_COLUMNS, "column_name", True))


def profile(source: str, columns: list[str]) -> str:
    missing = " + ".join(f"(count(*) - count({c}))" for c in columns)
    with_missing = " + ".join(f"CAST(count(*) > count({c}) AS BIGINT)" for c in columns)
    return (
        f"(SELECT count(*) AS dataset_rows, {missing} AS missing_cells, {with_missing} AS columns_with_missing,"
        f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicate_rows FROM {source})"
    )


_SCORE = (
    "greatest(100 - least(missing_percentage * 2, 50) - least(duplicate_rows::DOUBLE / dataset_rows * 300, 30), 0)"
)
oracle(
    "profile_summary",
    DELIVERIES,
    f"SELECT *, round({_SCORE}, 6) AS data_quality_score FROM (SELECT dataset_rows, 5::BIGINT AS dataset_columns,"
    " 3::BIGINT AS numeric_columns, 1::BIGINT AS datetime_columns, 1::BIGINT AS other_columns, missing_cells,"
    " round(missing_cells * 100.0::DOUBLE / (dataset_rows * 5), 6) AS missing_percentage, duplicate_rows, columns_with_missing"
    f" FROM {profile('deliveries', ['coin_id', 'timestamp', *BASE_COLUMNS])})",
)
oracle(
    "quality_score",
    DELIVERIES,
    f"SELECT round({_SCORE}, 6) AS data_quality_score FROM (SELECT *, missing_cells * 100.0::DOUBLE / (dataset_rows * 5) AS"
    f" missing_percentage FROM {profile('deliveries', ['coin_id', 'timestamp', *BASE_COLUMNS])})",
)
oracle(
    "missing_by_column",
    DELIVERIES,
    "SELECT * FROM ("
    + union(
        [
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
            f" round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_percentage FROM deliveries"
            for c in BASE_COLUMNS
        ]
    )
    + ") WHERE null_count > 0",
)
oracle(
    "duplicate_rows",
    DELIVERIES,
    f"SELECT {BASE}, occurrences FROM (SELECT coin_id, timestamp, {', '.join(BASE_COLUMNS)}, count(*) AS occurrences FROM deliveries"
    " GROUP BY ALL HAVING count(*) > 1 ORDER BY occurrences DESC, coin_id, timestamp, price NULLS FIRST, market_cap NULLS FIRST,"
    " total_volume NULLS FIRST LIMIT 10)",
)
_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rank_{c}" for c in BASE_COLUMNS
)
_PAIRS = [("price", "market_cap"), ("price", "total_volume"), ("market_cap", "total_volume")]
oracle(
    "correlation_matrix",
    HOURLY + f", ranked AS (SELECT *, {_RANKS} FROM hourly)",
    union(
        [
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) + 0 AS pearson,"
            f" round(corr(rank_{a}, rank_{b}), 6) + 0 AS spearman FROM ranked"
            for a, b in _PAIRS
        ]
    ),
)
oracle(
    "sample_rows",
    HOURLY,
    f"SELECT {BASE}, 'head' AS sample FROM (SELECT * FROM hourly ORDER BY timestamp, coin_id LIMIT 10) UNION ALL"
    f" SELECT {BASE}, 'tail' FROM (SELECT * FROM hourly ORDER BY timestamp DESC, coin_id DESC LIMIT 10)",
)

# drift -----------------------------------------------------------------------------------------

_SPLIT = f"row_number() OVER ({W}) - 1 >= count(*) OVER (PARTITION BY coin_id) - ceil(0.2 * count(*) OVER (PARTITION BY coin_id))"
PARTS = (
    COMPACT_ROWS
    + f", parted AS (SELECT *, {_SPLIT} AS is_test FROM featured)"
    + ", train AS (SELECT * FROM parted WHERE NOT is_test), rest AS (SELECT * FROM parted WHERE is_test)"
)
KNOWN = [c for c in NUMERIC if c != "price"]
oracle("training_stats", PARTS, stats("train", KNOWN, "feature", False))
_BOUNDS = union([f"SELECT '{c}' AS feature, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM train" for c in KNOWN])
oracle("drift_bounds", PARTS, f"SELECT feature, {rounded('low', 'high')} FROM ({_BOUNDS})")
_LONG = union([f"SELECT coin_id, timestamp, '{c}' AS feature, {c}::DOUBLE AS value FROM rest" for c in NUMERIC])
FLAGS = PARTS + (
    f", bounds AS ({_BOUNDS}), long AS ({_LONG}), flags AS (SELECT coin_id, timestamp, feature, value,"
    " coalesce(value < low OR value > high, false) AS is_drift FROM long LEFT JOIN bounds USING (feature))"
)
oracle("drift_flags", FLAGS, f"SELECT coin_id, timestamp, feature, {rounded('value')}, is_drift FROM flags")
RATIOS = FLAGS + ", ratios AS (SELECT coin_id, timestamp, avg(CAST(is_drift AS INTEGER)) AS drift_ratio FROM flags GROUP BY 1, 2)"
oracle("drift_ratio", RATIOS, f"SELECT coin_id, timestamp, {rounded('drift_ratio')} FROM ratios")
oracle(
    "drift_detections",
    FLAGS,
    "SELECT coin_id AS model_type, feature, count(*) AS detections FROM flags WHERE is_drift GROUP BY 1, 2",
)


def stretches(source: str, key: str, time: str, order: str, on: str, value: str, hold: int, step: int | None) -> str:
    """Gaps and islands: consecutive rows that meet the condition, closed by the next row that does not."""
    gap = f" OR epoch_us({time}) - epoch_us(prev_at) > {step * 1_000_000}" if step else ""
    until = "max(at_ts) FILTER (is_on)" if step else "coalesce(min(at_ts) FILTER (NOT is_on), max(at_ts) FILTER (is_on))"
    return (
        f"(SELECT {key}, since, until, peak, epoch_us(until) - epoch_us(since) >= {hold * 1_000_000} AS firing FROM ("
        f"SELECT {key}, min(at_ts) FILTER (is_on) AS since, {until} AS until, max(v) FILTER (is_on) AS peak FROM ("
        f"SELECT *, sum(starts) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM ("
        f"SELECT *, CASE WHEN is_on AND (NOT coalesce(prev_on, false){gap}) THEN 1 ELSE 0 END AS starts FROM ("
        f"SELECT *, lag(is_on) OVER (PARTITION BY {key} ORDER BY {order}) AS prev_on,"
        f" lag({time}) OVER (PARTITION BY {key} ORDER BY {order}) AS prev_at FROM ("
        f"SELECT *, {time} AS at_ts, coalesce({on}, false) AS is_on, {value} AS v FROM {source}))))"
        f" WHERE island > 0 GROUP BY {key}, island))"
    )


def drift_stretches(limit: float) -> str:
    return stretches("ratios", "coin_id", "timestamp", "timestamp", f"drift_ratio > {limit}", "drift_ratio", 120, None)


oracle("drift_alert", RATIOS, f"SELECT coin_id, since, until, {rounded('peak')}, firing FROM {drift_stretches(0.05)}")

# learning and evaluation -----------------------------------------------------------------------

_SCALED = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in BASE_COLUMNS)
oracle("standard_scale", HOURLY, f"SELECT {BASE} FROM (SELECT coin_id, timestamp, {_SCALED} FROM hourly)")
oracle("chrono_split", HOURLY, f"SELECT {BASE}, {_SPLIT} AS is_test FROM hourly")
NUMBERED = f"SELECT *, row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY coin_id) AS n FROM hourly"
_FOLD = (
    "CASE WHEN n > 30 THEN CASE WHEN pos < n - 3 * (n // 4) THEN 0 WHEN pos < n - 2 * (n // 4) THEN 1"
    " WHEN pos < n - (n // 4) THEN 2 ELSE 3 END"
    " ELSE CASE WHEN pos < n // 3 + CAST(n % 3 > 0 AS BIGINT) THEN 1"
    " WHEN pos < 2 * (n // 3) + least(n % 3, 2) THEN 2 ELSE 3 END END"
)
FOLDED = HOURLY + f", folded AS (SELECT *, CAST({_FOLD} AS INTEGER) AS fold FROM ({NUMBERED}))"
oracle("ts_cv_folds", FOLDED, f"SELECT {BASE}, fold, TRUE AS past_only FROM folded")
oracle(
    "contiguous_cv_folds",
    HOURLY,
    f"SELECT {BASE}, 1 + CAST(pos >= first AS INTEGER) + CAST(pos >= first + second AS INTEGER) AS fold, FALSE AS past_only FROM"
    " (SELECT *, n // 3 + CAST(n % 3 > 0 AS INTEGER) AS first, n // 3 + CAST(n % 3 > 1 AS INTEGER) AS second FROM"
    " (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY timestamp) - 1 AS pos, count(*) OVER (PARTITION BY coin_id) AS n FROM hourly))",
)
_GAPPY = (
    "gappy AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 11 <> 0 THEN ts END AS ts,"
    " CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)"
)
_GAPPY_ORDER = "PARTITION BY kind ORDER BY ts NULLS LAST, event_id"
oracle(
    "ordered_null_keys",
    _GAPPY,
    f"SELECT event_id, kind, round(last_value(value IGNORE NULLS) OVER ({_GAPPY_ORDER} ROWS UNBOUNDED PRECEDING), 6) AS value,"
    f" lag(event_id) OVER ({_GAPPY_ORDER}) AS prev_event_id, row_number() OVER ({_GAPPY_ORDER}) AS counter,"
    f" row_number() OVER ({_GAPPY_ORDER}) - 1 AS position, count(*) OVER (PARTITION BY kind) AS size FROM gappy",
)


def _gap_mean(span: int) -> str:
    """Mean at the last row with a value: weights count rows, and rows without a value scale both sums alike."""
    q = f"(1 - 2.0 / ({span} + 1))::DOUBLE"
    return (
        f"(SELECT a.event_id, sum(b.value * pow({q}, a.rn - b.rn)) / sum(pow({q}, a.rn - b.rn)) AS m FROM known a JOIN known b"
        f" ON a.event_type = b.event_type AND b.rn <= a.rn AND pow({q}, a.rn - b.rn) > 1e-30 GROUP BY 1)"
    )


oracle(
    "ewma_long_gaps",
    "numbered AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,"
    " CASE WHEN ts < TIMESTAMP '2024-01-03' OR ts > TIMESTAMP '2024-01-25' THEN value END AS value FROM events),"
    " known AS (SELECT * FROM numbered WHERE value IS NOT NULL)",
    "SELECT n.event_id, "
    + ", ".join(
        f"round(last_value(m{s}.m IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY rn ROWS UNBOUNDED PRECEDING), 6) AS value_ewma_{s}h" for s in (6, 24, 200)
    )
    + " FROM numbered n "
    + " ".join(f"LEFT JOIN {_gap_mean(s)} m{s} ON n.event_id = m{s}.event_id" for s in (6, 24, 200)),
)
#: Ridge with penalty 1 over two z-scores, centred on the training rows: a two by two system.
RIDGE = (
    HOURLY
    + f""",
two AS (SELECT *, {_SPLIT} AS is_test FROM hourly),
z AS (SELECT *, (market_cap - avg(market_cap) OVER ()) / stddev_pop(market_cap) OVER () AS z1,
  (total_volume - avg(total_volume) OVER ()) / stddev_pop(total_volume) OVER () AS z2 FROM two),
m AS (SELECT avg(z1) AS m1, avg(z2) AS m2, avg(price) AS my, var_pop(z1) * count(*) + 1 AS a, covar_pop(z1, z2) * count(*) AS b,
  var_pop(z2) * count(*) + 1 AS d, covar_pop(z1, price) * count(*) AS e, covar_pop(z2, price) * count(*) AS f FROM z WHERE NOT is_test),
w AS (SELECT *, (e * d - b * f) / (a * d - b * b) AS w1, (a * f - b * e) / (a * d - b * b) AS w2 FROM m),
predicted AS (SELECT z.*, my + w1 * (z1 - m1) + w2 * (z2 - m2) AS p FROM z, w)"""
)
_PREDICTED = (
    "coin_id, timestamp, round(p, 4) AS predicted_price, 'ridge' AS model_type, round(price, 4) AS current_price,"
    " round(p - price, 4) AS predicted_change, round((p - price) / price * 100, 4) AS predicted_change_pct"
)
_NEWEST = "FROM predicted QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY timestamp DESC) = 1"
oracle(
    "ridge_two_features",
    RIDGE,
    "SELECT 'ridge' AS model, TRUE AS is_best, "
    + ", ".join(
        f"round({f} FILTER ({'NOT ' if part == 'train' else ''}is_test){')' if root else ''}, 4) AS {part}_{name}"
        for part in ("train", "test")
        for name, f, root in (("rmse", "sqrt(avg(pow(price - p, 2))", True), ("mae", "avg(abs(price - p))", False))
    )
    + " FROM predicted",
)


def _two_by_two(source: str, by: str = "") -> str:
    """Terms of the normal equations of a ridge over z1 and z2 with penalty 1."""
    return (
        f"SELECT {by}{', ' if by else ''}count(*) AS train_rows, avg(z1) AS m1, avg(z2) AS m2, avg(price) AS my, var_pop(z1) * count(*) + 1 AS a,"
        " covar_pop(z1, z2) * count(*) AS b, var_pop(z2) * count(*) + 1 AS d, covar_pop(z1, price) * count(*) AS e,"
        f" covar_pop(z2, price) * count(*) AS f FROM {source}{' GROUP BY ' + by if by else ''}"
    )


_SOLVE = "SELECT *, (e * d - b * f) / (a * d - b * b) AS w1, (a * f - b * e) / (a * d - b * b) AS w2 FROM m"
oracle(
    "ridge_cv",
    RIDGE[: RIDGE.index(",\nm AS")]
    + f""",
hourly_train AS (SELECT * FROM z WHERE NOT is_test),
folded AS (SELECT *, {_FOLD} AS fold FROM ({NUMBERED.replace('FROM hourly', 'FROM hourly_train')})),
each AS (SELECT k, folded.* FROM folded, (SELECT unnest([1, 2, 3]) AS k) WHERE fold < k),
m AS ({_two_by_two('each', 'k')}), w AS ({_SOLVE})""",
    "SELECT fold, train_rows, count(*) AS valid_rows, round(sqrt(avg(pow(price - (my + w1 * (z1 - m1) + w2 * (z2 - m2)), 2))), 4) AS rmse"
    " FROM folded JOIN w ON fold = k GROUP BY fold, train_rows",
)
oracle(
    "ridge_per_series",
    HOURLY
    + f""",
two AS (SELECT *, {_SPLIT} AS is_test FROM hourly),
s AS (SELECT coin_id, avg(market_cap) AS mc, stddev_pop(market_cap) AS sc, avg(total_volume) AS mv, stddev_pop(total_volume) AS sv
  FROM two WHERE NOT is_test GROUP BY 1),
z AS (SELECT two.*, (market_cap - mc) / sc AS z1, (total_volume - mv) / sv AS z2 FROM two JOIN s USING (coin_id)),
m AS ({_two_by_two('z WHERE NOT is_test', 'coin_id')}), w AS ({_SOLVE}),
predicted AS (SELECT z.*, my + w1 * (z1 - m1) + w2 * (z2 - m2) AS p FROM z JOIN w USING (coin_id))""",
    "SELECT coin_id, is_test, round(sqrt(avg(pow(price - p, 2))), 4) AS rmse, round(avg(abs(price - p)), 4) AS mae, count(*) AS sample_count"
    " FROM predicted GROUP BY 1, 2",
)
oracle(
    "forecast_linear",
    "RECURSIVE "
    + HOURLY.strip()
    + f""",
changed AS (SELECT * FROM (SELECT *, price - {lag('price', 1)} AS change FROM hourly) WHERE change IS NOT NULL),
two AS (SELECT *, {_SPLIT} AS is_test FROM changed),
s AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(change) AS mc, stddev_pop(change) AS sc FROM two),
z AS (SELECT two.*, (price - mp) / sp AS z1, (change - mc) / sc AS z2 FROM two, s),
m AS ({_two_by_two('z WHERE NOT is_test')}), w AS (SELECT * FROM ({_SOLVE}), s),
steps AS (
  SELECT coin_id, timestamp, price, change, 0 AS h FROM (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY timestamp DESC) = 1)
  UNION ALL
  SELECT coin_id, timestamp + INTERVAL 1 HOUR, p, p - price, h + 1
  FROM (SELECT steps.*, my + w1 * ((price - mp) / sp - m1) + w2 * ((change - mc) / sc - m2) AS p FROM steps, w) WHERE h < 24)""",
    "SELECT coin_id, timestamp, round(price, 4) AS predicted_price, h AS hours_ahead, 'ridge' AS model_type FROM steps WHERE h > 0",
)
oracle("predict_single", RIDGE, f"SELECT {_PREDICTED} {_NEWEST}")
oracle(
    "scoring_pipeline",
    RIDGE
    + """,
bounds AS (SELECT min(market_cap) AS cl, max(market_cap) AS ch, min(total_volume) AS vl, max(total_volume) AS vh FROM two WHERE NOT is_test)""",
    f"SELECT n.*, round((CAST(market_cap < cl OR market_cap > ch AS INTEGER) + CAST(total_volume < vl OR total_volume > vh AS INTEGER)) / 2.0, 4)"
    f" AS drift_ratio FROM (SELECT {_PREDICTED} {_NEWEST}) n JOIN two USING (coin_id, timestamp), bounds",
)
oracle(
    "predict_job",
    RIDGE,
    "SELECT coin_id, round(sqrt(avg(pow(price - p, 2))), 4) AS rmse, round(avg(abs(price - p)), 4) AS mae, count(*) AS sample_count FROM predicted GROUP BY 1",
)
NAIVE = HOURLY + f", naive AS (SELECT coin_id, timestamp, price AS a, {lag('price', 1)} AS p FROM hourly)"


def scores(source: str, by: str, denominator: str, a: str = "a", p: str = "p") -> str:
    """Metrics with the mean taken first and the squares summed in a second pass."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return (
        f"(SELECT {key}avg(pow(a - p, 2)) AS mse, avg(abs(a - p)) AS mae, sqrt(avg(pow(a - p, 2))) AS rmse,"
        f" avg(abs({div('a - p', denominator)})) * 100 AS mape, 1 - sum(pow(a - p, 2)) / sum(pow(a - m, 2)) AS r2,"
        f" count(*) AS sample_count FROM (SELECT *, avg(a) {over} AS m FROM (SELECT {key}{a} AS a, {p} AS p FROM {source})"
        f" WHERE a IS NOT NULL AND p IS NOT NULL) {group})"
    )


METRICS = ["mse", "mae", "rmse", "mape", "r2"]
oracle("evaluate_forecast", NAIVE, f"SELECT coin_id, {rounded(*METRICS)}, sample_count FROM {scores('naive', 'coin_id', 'a')}")
oracle(
    "directional_accuracy",
    NAIVE,
    "SELECT coin_id, round(avg(CASE WHEN sign(a - pa) = sign(p - pp) THEN 100.0 ELSE 0 END), 6) AS directional_accuracy FROM"
    f" (SELECT *, lag(a) OVER ({W}) AS pa, lag(p) OVER ({W}) AS pp FROM naive WHERE p IS NOT NULL) WHERE pa IS NOT NULL GROUP BY 1",
)
oracle(
    "evaluate_train_test",
    NAIVE + f", parted AS (SELECT *, {_SPLIT} AS is_test FROM naive)",
    f"SELECT is_test, {rounded(*METRICS)}, sample_count FROM {scores('parted', 'is_test', 'greatest(abs(a), 2.220446049250313e-16)')}",
)
oracle(
    "cv_summary",
    FOLDED + f", scored AS (SELECT fold, price AS a, {lag('price', 1)} AS p FROM folded)",
    "SELECT round(sqrt(avg(mse)), 6) AS cv_rmse_mean, round(sqrt(stddev_pop(mse)), 6) AS cv_rmse_std FROM"
    " (SELECT fold, avg(pow(a - p, 2)) AS mse FROM scored WHERE fold > 0 GROUP BY 1)",
)
_MEAN6 = roll("avg", "price", 6)
GATE = HOURLY + (
    f", lagged AS (SELECT price AS actual, {lag('price', 1)} AS p1, {lag('mean6', 1)} AS p2, coin_id FROM"
    f" (SELECT *, {_MEAN6} AS mean6 FROM hourly) WINDOW ww AS ({W})), both_known AS (SELECT * FROM lagged WHERE p2 IS NOT NULL)"
).replace(" WINDOW ww AS (" + W + ")", "")
_OLD, _NEW = (scores("both_known", "", "a", "actual", p) for p in ("p1", "p2"))
oracle(
    "model_gate",
    GATE,
    f"SELECT metric, {rounded('production', 'candidate', 'change_pct')},"
    " CASE WHEN metric = 'r2' THEN candidate >= production ELSE candidate <= production END AS passed FROM ("
    "SELECT *, (candidate - production) / production * 100 AS change_pct FROM ("
    + union([f"SELECT '{m}' AS metric, o.{m} AS production, n.{m} AS candidate FROM {_OLD} o, {_NEW} n" for m in ("rmse", "mae", "r2")])
    + "))",
)

# requests, rates and alerts ----------------------------------------------------------------------

oracle("request_counts", LOG, "SELECT endpoint, status, model_type, count(*) AS requests FROM log GROUP BY 1, 2, 3")
oracle(
    "endpoint_summary",
    LOG,
    "SELECT endpoint, status, count(*) AS requests, round(avg(latency_s), 6) AS mean_latency_s FROM log GROUP BY 1, 2",
)
oracle(
    "prediction_metrics",
    LOG,
    "SELECT model_type, endpoint AS coin_id, count(*) AS predictions, round(avg(latency_s), 6) AS mean_latency_s FROM log GROUP BY 1, 2",
)


def histogram(label: str, buckets: tuple[float, ...]) -> str:
    bounds = ", ".join(f"('{b:g}', {b})" for b in buckets) + ", ('+Inf', 'inf'::DOUBLE)"
    return (
        f"SELECT {label}, round(sum(latency_s), 6) AS value_sum, le, count(*) FILTER (latency_s <= bound) AS observations"
        f" FROM log, (VALUES {bounds}) b(le, bound) GROUP BY {label}, le"
    )


oracle("latency_histogram", LOG, histogram("endpoint", REQUEST_BUCKETS))
oracle("prediction_histogram", LOG, histogram("model_type", PREDICTION_BUCKETS))
oracle(
    "active_requests",
    LOG,
    "SELECT ts, CAST(sum(step) OVER (ORDER BY ts) AS BIGINT) AS active FROM (SELECT ts, sum(step) AS step FROM"
    " (SELECT ts, 1 AS step FROM log UNION ALL SELECT end_ts, -1 FROM log) GROUP BY 1)",
)
oracle(
    "counter_series",
    LOG,
    "SELECT endpoint, ts, event_id, count(*) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS counter FROM log",
)


def ranges(labels: str, source: str, time: str, seconds: int, step: int, measures: str) -> str:
    """Every event joined with each evaluation instant whose range holds it."""
    first = f"(CAST(floor(epoch_us({time}) / {step}e6) AS BIGINT) + 1) * {step}"
    return (
        f"(SELECT {labels}, to_timestamp(e)::TIMESTAMP AS window_end, {measures} FROM (SELECT *, unnest(range({first},"
        f" {first} + {seconds}, {step})) AS e FROM {source}) GROUP BY {labels}, e)"
    )


_RATE = ranges("endpoint, status", "log", "ts", 300, 30, "round(count(*) / 300.0, 6) AS rate")
oracle("counter_rate", LOG, f"SELECT * FROM {_RATE}")
oracle("stream_counter_rate", LOG, f"SELECT * FROM {_RATE}")
oracle(
    "counter_rate_filled",
    LOG + f", rates AS (SELECT * FROM {_RATE})",
    "SELECT g.endpoint, g.status, g.window_end, coalesce(r.rate, 0) AS rate FROM (SELECT endpoint, status,"
    " unnest(generate_series(min(window_end), max(window_end), INTERVAL 30 SECOND)) AS window_end FROM rates GROUP BY 1, 2) g"
    " LEFT JOIN rates r USING (endpoint, status, window_end)",
)
oracle(
    "request_counts_by_method",
    LOG,
    "SELECT CASE WHEN endpoint IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method, endpoint,"
    " CASE WHEN endpoint = 'error' THEN 'error' ELSE 'success' END AS status, count(*) AS requests FROM log GROUP BY 1, 2, 3",
)
oracle(
    "sampled_counter_rate",
    LOG
    + """,
slots AS (SELECT endpoint, (CAST(floor(epoch_us(ts) / 30e6) AS BIGINT)) * 30 AS s, count(*) AS n FROM log GROUP BY 1, 2),
samples AS (SELECT endpoint, to_timestamp(s + 30)::TIMESTAMP AS ts,
  sum(n) OVER (PARTITION BY endpoint, s // 86400 ORDER BY s ROWS UNBOUNDED PRECEDING) AS v FROM slots),
rises AS (SELECT endpoint, ts, CASE WHEN v < pv THEN v ELSE v - pv END AS increase FROM
  (SELECT *, lag(v) OVER (PARTITION BY endpoint ORDER BY ts) AS pv FROM samples) WHERE pv IS NOT NULL)""",
    f"SELECT * FROM {ranges('endpoint', 'rises', 'ts', 300, 30, 'round(sum(increase) / 300.0, 6) AS rate')}",
)
oracle("increase_by_status", LOG, f"SELECT * FROM {ranges('status', 'log', 'ts', 3600, 300, 'count(*) AS increase')}")
_COUNTS = ", ".join(f"count(*) FILTER (latency_s <= {b}) AS c{i}" for i, b in enumerate(REQUEST_BUCKETS)) + ", count(*) AS total"
_BUCKETED = ranges("endpoint", "log", "ts", 300, 30, _COUNTS)


def quantile(q: float) -> str:
    cases, low, before = [], 0.0, "0"
    for i, b in enumerate(REQUEST_BUCKETS):
        cases.append(f"WHEN c{i} >= {q} * total THEN {low} + ({b} - {low}) * ({q} * total - {before}) / (c{i} - {before})")
        low, before = b, f"c{i}"
    return f"round(CASE {' '.join(cases)} ELSE {REQUEST_BUCKETS[-1]} END, 6)"


_QUANTILES = f"SELECT endpoint, window_end, {quantile(0.5)} AS p50, {quantile(0.95)} AS p95, {quantile(0.99)} AS p99 FROM {_BUCKETED}"
oracle("latency_quantiles", LOG, _QUANTILES)
oracle("stream_latency_quantiles", LOG, _QUANTILES)
HEALTH = ", health AS (SELECT *, CASE WHEN status = 'error' THEN 0 ELSE 1 END AS health FROM log)"
oracle(
    "gauge_last",
    LOG + HEALTH,
    "SELECT model_type, CAST(last(health ORDER BY ts, event_id) AS INTEGER) AS health FROM health GROUP BY 1",
)
_HEALTH = stretches("health", "model_type", "ts", "ts, event_id", "health = 0", "health", 60, None)
oracle("model_health_alert", LOG + HEALTH, f"SELECT * REPLACE (CAST(peak AS INTEGER) AS peak) FROM {_HEALTH}")
BURST = """
burst AS (
  SELECT event_id, CASE WHEN event_id % 10 < 9 THEN TIMESTAMP '2024-01-15 12:00:00' + to_microseconds(event_id * 7919 % 1000 * 1000) ELSE ts END AS ts,
         CASE WHEN event_id % 10 < 9 THEN 'view' ELSE event_type END AS endpoint, CASE WHEN event_id % 7 < 3 THEN value END AS value
  FROM events)"""
oracle(
    "burst_running_count",
    BURST,
    "SELECT endpoint, ts, event_id, count(*) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS counter FROM burst",
)
oracle(
    "burst_forward_fill",
    BURST,
    "SELECT event_id, ts, endpoint, round(last_value(value IGNORE NULLS) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS value FROM burst",
)
oracle("burst_alert", BURST, f"SELECT * FROM {stretches('burst', 'endpoint', 'ts', 'ts, event_id', 'value > 50', 'value', 0, None)}")
_GRID = """, grid AS (
  SELECT model_type, to_timestamp(e)::TIMESTAMP AS instant, CAST(last(health ORDER BY ts, event_id) AS INTEGER) AS health
  FROM (SELECT *, unnest(range(CAST(ceil(epoch_us(ts) / 30e6) AS BIGINT) * 30, CAST(ceil(epoch_us(ts) / 30e6) AS BIGINT) * 30 + 301, 30)) AS e FROM health)
  WHERE e * 1000000 - epoch_us(ts) < 300000000 GROUP BY 1, 2)"""
oracle("gauge_on_grid", LOG + HEALTH + _GRID, "SELECT * FROM grid")
oracle(
    "model_health_alert_on_grid",
    LOG + HEALTH + _GRID,
    f"SELECT * REPLACE (CAST(peak AS INTEGER) AS peak) FROM {stretches('grid', 'model_type', 'instant', 'instant', 'health = 0', 'health', 60, 30)}",
)
oracle(
    "stream_health_alert",
    LOG + HEALTH + _GRID,
    f"SELECT * REPLACE (CAST(peak AS INTEGER) AS peak) FROM {stretches('grid', 'model_type', 'instant', 'instant', 'health = 0', 'health', 60, 30)}",
)
oracle(
    "prediction_drift",
    RATIOS + "," + LOG + ", settings AS (SELECT 'm' || (hour(timestamp) % 3) AS model_type, coin_id, timestamp + INTERVAL 1 HOUR AS at, drift_ratio FROM ratios)",
    "SELECT l.model_type, l.endpoint AS coin_id, l.ts, event_id, round(latency_s, 6) AS latency_s, round(drift_ratio, 6) + 0 AS drift_ratio"
    " FROM log l ASOF LEFT JOIN settings s ON l.model_type = s.model_type AND l.endpoint = s.coin_id AND l.ts >= s.at",
)
_SLOW = stretches("quantiles", "endpoint", "window_end", "window_end", "p95 > 0.5", "p95", 300, 30)
oracle("alert_for_duration", LOG + f", quantiles AS ({_QUANTILES})", f"SELECT * FROM {_SLOW}")
_ERRORS = stretches("error_rates", "endpoint", "window_end", "window_end", "rate > 0.1", "rate", 300, 30)
oracle(
    "stream_error_rate_alert",
    LOG + f", error_rates AS (SELECT * FROM {_RATE} WHERE status = 'error')",
    f"SELECT * FROM {stretches('error_rates', 'endpoint', 'window_end', 'window_end', 'rate > 0.005', 'rate', 300, 30)}",
)


def fired(alert: str, severity: str, label: str, source: str) -> str:
    return (
        f"SELECT '{alert}' AS alert, '{severity}' AS severity, {label} AS label, since, until, round(peak::DOUBLE, 6) AS peak"
        f" FROM {source} WHERE firing"
    )


oracle(
    "alerts",
    RATIOS + "," + LOG + HEALTH + f", quantiles AS ({_QUANTILES}), error_rates AS (SELECT * FROM {_RATE} WHERE status = 'error')",
    union(
        [
            fired("HighAPILatency", "warning", "endpoint", _SLOW),
            fired("DataDriftSpike", "warning", "coin_id", drift_stretches(0.3)),
            fired("ModelUnhealthy", "critical", "model_type", _HEALTH),
            fired("HighErrorRate", "critical", "endpoint", _ERRORS),
        ]
    ),
)

# digests ---------------------------------------------------------------------------------------


def digest(source: str, values: list[str]) -> str:
    """Rows and digest of a relation: lengths and texts of the values of every row, MD5 in two parts, summed."""
    text = " || ".join(f"CASE WHEN {v} IS NULL THEN 'n;' ELSE length({v}::VARCHAR) || ':' || {v}::VARCHAR || ';' END" for v in values)
    parts = [f"coalesce(sum(('0x' || substr(h, {k}, 15))::UBIGINT::HUGEINT), 0)::VARCHAR" for k in (1, 16)]
    return f"SELECT count(*) AS rows, {parts[0]} || '-' || {parts[1]} AS digest FROM (SELECT md5({text}) AS h FROM {source})"


_EVENT_VALUES = ["event_id", "epoch_us(ts)", "user_id", "event_type", "value", "props"]
ORACLE["table_fingerprint"] = digest("events", _EVENT_VALUES)
ORACLE["content_manifest"] = (
    "SELECT 'events.parquet' AS file_name, rows, digest, substr(md5(digest), 1, 2) || '/' || substr(md5(digest), 3) AS content_key"
    f" FROM ({digest('events', _EVENT_VALUES)})"
)

ORACLE["publish_verify"] = (
    f"WITH {HOURLY} SELECT 'hourly' AS name, 'processed/20240131_000000_hourly' AS key, count(*) AS rows, TRUE AS verified FROM hourly"
)

# streams ---------------------------------------------------------------------------------------

_PAST = "FROM events WHERE ts < TIMESTAMP '2024-01-22'"
oracle(
    "stream_drift_ratio",
    f"b AS (SELECT min(value) AS vl, max(value) AS vh, min(user_id) AS ul, max(user_id) AS uh {_PAST})",
    "SELECT event_id, round((CAST(value < vl OR value > vh AS INTEGER) + CAST(user_id < ul OR user_id > uh AS INTEGER)) / 3.0, 6)"
    " AS drift_ratio FROM events, b",
)
oracle(
    "incremental_merge",
    HOURLY,
    "SELECT coin_id, timestamp, round(price + CASE WHEN timestamp <= first + INTERVAL 14 DAY THEN 0 WHEN timestamp <="
    " first + INTERVAL 24 DAY THEN 1 ELSE 2 END, 6) AS price, round(market_cap, 6) AS market_cap,"
    " round(total_volume, 6) AS total_volume FROM hourly, (SELECT min(timestamp) AS first FROM hourly)",
)
oracle("incremental_features", *featured(HOURLY, "hourly", COMPACT, complete=True, ewma=(6, 12)))
oracle("staged_versions", HOURLY, "SELECT coin_id, timestamp, price, market_cap, total_volume, '20240131' AS version FROM hourly WHERE timestamp < TIMESTAMP '2024-02-01'")
