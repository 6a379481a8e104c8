"""Request and prediction metrics: counters, histograms, rates, quantiles, gauges and alerts.

Range operators first count events into short slots (as long as the evaluation step) and then add
slots up to ranges, so an event is never copied once per overlapping range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.expressions import number
from tideframe.operators.drift import ALERT_RATIO
from tideframe.plans.ordered import EVENT_LOG, Carry, GROUP, SO_FAR, Series, bucket_path, grouped, previous, running_total, with_carry
from tideframe.session import materialize
from tideframe.sources.tables import event_order

# Histogram bounds, rule ranges, thresholds and hold times.
REQUEST_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PREDICTION_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
RATE_SECONDS, INCREASE_SECONDS, STEP_SECONDS = 300, 3600, 30
QUANTILES = (0.5, 0.95, 0.99)
LATENCY_LIMIT, ERROR_RATE_LIMIT = 0.5, 0.1
HOLD_SECONDS = {"HighAPILatency": 300, "DataDriftSpike": 120, "ModelUnhealthy": 60, "HighErrorRate": 300}
SEVERITY = {"HighAPILatency": "warning", "DataDriftSpike": "warning", "ModelUnhealthy": "critical", "HighErrorRate": "critical"}

GRID = Series(keys=("endpoint",), time="window_end", fine="day")


def request_counts(log: DataFrame, labels: Sequence[str] = ("endpoint", "status")) -> DataFrame:
    """Number of requests per label set; also valid as a streaming aggregation."""
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("requests"))


def with_status(log: DataFrame, code: str = "status_code") -> DataFrame:
    """Add ``status`` from the response code: success below 400, error otherwise and without a response."""
    return log.withColumn("status", F.expr(f"CASE WHEN {code} < 400 THEN 'success' ELSE 'error' END"))


def endpoint_summary(log: DataFrame, labels: Sequence[str] = ("endpoint", "status")) -> DataFrame:
    """Requests and mean response time per endpoint and status."""
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("requests"), F.avg("latency_s").alias("mean_latency_s"))


def cumulative_counts(value: str, buckets: Sequence[float]) -> dict[str, str]:
    """One conditional count per bucket bound: values up to and including the bound."""
    return {f"le{i}": f"count_if({value} <= {number(b)})" for i, b in enumerate(buckets)}


def latency_histogram(
    log: DataFrame,
    labels: Sequence[str] = ("endpoint",),
    value: str = "latency_s",
    buckets: Sequence[float] = REQUEST_BUCKETS,
) -> DataFrame:
    """Cumulative histogram rows (labels, le, observations) with the sum; the last bound is +Inf."""
    counts = cumulative_counts(value, buckets) | {"total": "count(1)", "value_sum": f"sum({value})"}
    wide = log.groupBy(*labels).agg(*[F.expr(e).alias(n) for n, e in counts.items()])
    cells = [f"struct('{b:g}' AS le, le{i} AS observations)" for i, b in enumerate(buckets)]
    cells.append("struct('+Inf' AS le, total AS observations)")
    return wide.selectExpr(*labels, "value_sum", f"inline(array({', '.join(cells)}))")


def _slot(time: str, step: int) -> str:
    return f"timestamp_seconds(unix_seconds({time}) div {step} * {step})"


def over_ranges(
    log: DataFrame,
    labels: Sequence[str],
    measures: dict[str, str],
    time: str = "ts",
    seconds: int = RATE_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Additive measures over ranges of ``seconds`` that end at every ``step``.

    The range [end - seconds, end) is labelled by ``window_end``. Ranges without events give no row;
    :func:`fill_ranges` adds them.
    """
    return ranges_of(slot_measures(log, labels, measures, time, step), labels, list(measures), seconds, step)


def slot_measures(log: DataFrame, labels: Sequence[str], measures: dict[str, str], time: str = "ts", step: int = STEP_SECONDS) -> DataFrame:
    """Measures per slot of ``step`` seconds; ``__slot`` is its start."""
    return log.groupBy(*labels, F.expr(_slot(time, step)).alias("__slot")).agg(*[F.expr(e).alias(n) for n, e in measures.items()])


def ranges_of(
    slots: DataFrame, labels: Sequence[str], measures: Sequence[str], seconds: int = RATE_SECONDS, step: int = STEP_SECONDS
) -> DataFrame:
    """Slots added up to ranges."""
    ends = f"explode(sequence(__slot + INTERVAL {step} SECOND, __slot + INTERVAL {seconds} SECOND, INTERVAL {step} SECOND))"
    spread = slots.selectExpr(*labels, *measures, f"{ends} AS window_end")
    return spread.groupBy(*labels, "window_end").agg(*[F.sum(n).alias(n) for n in measures])


def fill_ranges(ranges: DataFrame, labels: Sequence[str], measures: Sequence[str], step: int = STEP_SECONDS) -> DataFrame:
    """Every range between the first and the last one of a label set; those without events have zeros."""
    spans = ranges.groupBy(*labels).agg(F.min("window_end").alias("__first"), F.max("window_end").alias("__last"))
    grid = spans.selectExpr(*labels, f"explode(sequence(__first, __last, INTERVAL {step} SECOND)) AS window_end")
    same = F.lit(True)
    left, right = grid.alias("g"), ranges.alias("r")
    for c in [*labels, "window_end"]:
        same = same & F.col(f"g.{c}").eqNullSafe(F.col(f"r.{c}"))
    zero = [f"coalesce(r.{m}, 0) AS {m}" for m in measures]
    return left.join(right, same, "left").selectExpr(*[f"g.{c}" for c in labels], "g.window_end", *zero)


def counter_rate(log: DataFrame, labels: Sequence[str] = ("endpoint", "status")) -> DataFrame:
    """Events per second over the last five minutes, every 30 seconds. Ranges are not extrapolated."""
    counts = over_ranges(log, labels, {"n": "count(1)"})
    return counts.selectExpr(*labels, "window_end", f"n / {float(RATE_SECONDS)!r}D AS rate")


def increase_by_status(log: DataFrame, labels: Sequence[str] = ("status",), step: int = RATE_SECONDS) -> DataFrame:
    """Events over the last hour per status, evaluated every five minutes."""
    return over_ranges(log, labels, {"increase": "count(1)"}, seconds=INCREASE_SECONDS, step=step)


def counter_series(log: DataFrame, labels: Sequence[str] = ("endpoint",), series: Series = EVENT_LOG) -> DataFrame:
    """The counter value each event leaves behind: a running count per label set."""
    return running_total(log, series.by(*labels), "1L", "counter").select(*labels, series.time, *series.ties, "counter")


def scrape_counter(log: DataFrame, labels: Sequence[str] = ("endpoint",), step: int = STEP_SECONDS, restart: str = "day") -> DataFrame:
    """Counter samples as a scraper sees them: the running count at the end of each active slot.

    The counter starts again at zero with every ``restart`` period.
    """
    slots = log.groupBy(*labels, F.expr(_slot("ts", step)).alias("__slot")).agg(F.count(F.lit(1)).alias("n"))
    since = f"OVER (PARTITION BY {', '.join(labels)}, date_trunc('{restart}', __slot) ORDER BY __slot ROWS UNBOUNDED PRECEDING)"
    return slots.selectExpr(*labels, f"__slot + INTERVAL {step} SECOND AS ts", f"sum(n) {since} AS value")


def counter_increase(samples: DataFrame, series: Series, value: str = "value") -> DataFrame:
    """Increase since the sample before; a falling counter has restarted and counts from zero.

    The first sample of a series has nothing to compare with and gives no increase.
    """
    steps = previous(samples, series, [value]).where(f"prev_{value} IS NOT NULL")
    rise = f"CASE WHEN {value} < prev_{value} THEN {value} ELSE {value} - prev_{value} END AS increase"
    return steps.selectExpr(*series.keys, series.time, rise)


def sampled_rate(samples: DataFrame, series: Series, value: str = "value") -> DataFrame:
    """Per-second rate over five minutes from counter samples, restarts taken into account."""
    rises = counter_increase(samples, series, value)
    sums = over_ranges(rises, series.keys, {"increase": "sum(increase)"}, time=series.time)
    return sums.selectExpr(*series.keys, "window_end", f"increase / {float(RATE_SECONDS)!r}D AS rate")


def bucket_quantile(q: float, counts: Sequence[str], total: str, buckets: Sequence[float]) -> str:
    """Quantile from cumulative bucket counts: straight line inside the bucket that reaches the rank.

    The first bucket starts at zero; a rank beyond the last bound gives the last bound.
    """
    rank = f"({float(q)!r}D * {total})"
    cases = []
    for i, bound in enumerate(buckets):
        low, before = (0.0, "0") if i == 0 else (buckets[i - 1], counts[i - 1])
        share = f"coalesce(try_divide({rank} - {before}, {counts[i]} - {before}), 0D)"
        cases.append(f"WHEN {counts[i]} >= {rank} THEN {number(low)} + {number(bound - low)} * {share}")
    return f"CASE {' '.join(cases)} ELSE {number(buckets[-1])} END"


def latency_quantiles(
    log: DataFrame,
    labels: Sequence[str] = ("endpoint",),
    quantiles: Sequence[float] = QUANTILES,
    buckets: Sequence[float] = REQUEST_BUCKETS,
    value: str = "latency_s",
) -> DataFrame:
    """Bucket quantiles of response times over five minutes, every 30 seconds."""
    measures = cumulative_counts(value, buckets) | {"total": "count(1)"}
    return quantiles_of(over_ranges(log, labels, measures), labels, quantiles, buckets)


def quantiles_of(
    ranges: DataFrame, labels: Sequence[str], quantiles: Sequence[float] = QUANTILES, buckets: Sequence[float] = REQUEST_BUCKETS
) -> DataFrame:
    """Quantile columns from the bucket counts of each range."""
    names = [f"le{i}" for i in range(len(buckets))]
    columns = [f"{bucket_quantile(q, names, 'total', buckets)} AS p{round(q * 100)}" for q in quantiles]
    return ranges.selectExpr(*labels, "window_end", *columns)


def active_requests(log: DataFrame, series: Series = EVENT_LOG) -> DataFrame:
    """Requests in flight right after every instant at which one starts or ends."""
    moves = log.selectExpr("inline(array(struct(ts AS at, 1L AS step), struct(end_ts AS at, -1L AS step)))")
    instants = moves.groupBy(F.col("at").alias("ts")).agg(F.sum("step").alias("step"))
    flow = Series(keys=(), time="ts", fine=series.fine, coarse=series.coarse)
    return running_total(instants, flow, "step", "active").select("ts", "active")


def gauge_last(samples: DataFrame, labels: Sequence[str], value: str, time: str = "ts", event_id: str = "event_id") -> DataFrame:
    """The value set last per label set."""
    return samples.groupBy(*labels).agg(F.max_by(value, event_order(time, event_id)).alias(value))


def gauge_on_grid(
    samples: DataFrame,
    labels: Sequence[str],
    value: str,
    time: str = "ts",
    event_id: str = "event_id",
    step: int = STEP_SECONDS,
    look_back: int = RATE_SECONDS,
) -> DataFrame:
    """(labels, instant, value): the gauge at every evaluation instant, as long as its last sample is younger than ``look_back`` seconds.

    A sample counts at the instant it is set. Only the last sample of a step can be seen on the grid, so samples are
    reduced to one per step first, and that one is handed to the instants it may be seen at; the youngest wins, a null
    value like any other. Samples without a time are never seen.
    """
    end = f"CAST(ceil(unix_micros({time}) / {step}e6D) AS BIGINT) * {step}L"
    youngest = F.max_by(F.struct(F.col(value).alias("v"), F.col(time).alias("t")), event_order(time, event_id)).alias("__last")
    seen = samples.where(f"{time} IS NOT NULL").withColumn("__end", F.expr(end)).groupBy(*labels, "__end").agg(youngest)
    # an instant e sees samples of (e - look_back, e]
    instants = f"filter(sequence(__end, __end + {look_back}L, {step}L), e -> e * 1000000L - unix_micros(__last.t) < {look_back * 1_000_000}L)"
    copies = seen.selectExpr(*labels, "__end", "__last", f"explode({instants}) AS __at")
    found = copies.groupBy(*labels, "__at").agg(F.max_by("__last", "__end").alias("__last"))
    return found.selectExpr(*labels, "timestamp_seconds(__at) AS instant", f"__last.v AS {value}")


def grid_alert(grid: DataFrame, labels: Sequence[str], condition: str, hold_seconds: int, value: str, step: int = STEP_SECONDS) -> DataFrame:
    """Stretches of evaluation instants at which the condition held; an instant without a value ends a stretch."""
    return sustained(grid, Series(tuple(labels), "instant", (), "day"), condition, hold_seconds, value, step)


def as_of_join(events: DataFrame, settings: DataFrame, series: Series, values: Sequence[str]) -> DataFrame:
    """Every event with the ``values`` set last at or before it, per keys of the series.

    Both frames have the keys, the time and the tie breakers of the series. Settings of the event's own instant count; of settings of one instant
    the one of the highest tie breakers does. A value set to null replaces the one before. Events before any setting, and events without a
    time, get nulls; events without a key meet settings without that key. Rows of both flow through one ordered pass, bucket by bucket.
    """
    keys, order = list(series.keys), [series.time, *series.ties]
    event = events.select(*keys, *order, F.lit(1).alias("__kind"), F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("__event"))
    chosen = settings.where(F.col(series.time).isNotNull()).select(*keys, *order, F.lit(0).alias("__kind"), F.struct(*values).alias("__set"))
    both = event.unionByName(chosen, allowMissingColumns=True)
    both = both.withColumn("__order", F.expr(f"struct({', '.join([series.time, '__kind', *series.ties])})"))
    by_kind = replace(series, ties=("__kind", *series.ties))
    latest = Carry("__earlier", "max(CASE WHEN __kind = 0 THEN struct(__order, __set AS v) END)", "max")
    known = with_carry(both, by_kind, [latest])
    here = f"last(CASE WHEN __kind = 0 THEN struct(__set AS v) END, true) {by_kind.local(SO_FAR)}"
    known = known.selectExpr("__kind", "__event", series.time, f"coalesce({here}.v, __earlier.v) AS __v").where("__kind = 1")
    return known.selectExpr("__event.*", *[f"CASE WHEN {series.time} IS NOT NULL THEN __v.{v} END AS {v}" for v in values])


def prediction_metrics(log: DataFrame) -> DataFrame:
    """Predictions per model and series with their mean response time."""
    labels = [F.col("model_type"), F.col("endpoint").alias("coin_id")]
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("predictions"), F.avg("latency_s").alias("mean_latency_s"))


def sustained(
    samples: DataFrame,
    series: Series,
    condition: str,
    hold_seconds: int,
    value: str,
    step_seconds: int | None = None,
) -> DataFrame:
    """Stretches over which ``condition`` held without a break, and whether they lasted long enough.

    With ``step_seconds`` the samples are evaluations on a grid and a missing one ends the stretch;
    without it a sample holds until the next one, as a gauge does. ``until`` is then the first sample
    that no longer meets the condition (or the last sample, if none does).
    """
    labels = list(series.keys)
    path = bucket_path(series)
    marked = samples.selectExpr(*labels, series.time, *series.ties, *path, f"coalesce({condition}, false) AS __on", f"{value} AS __measure")
    # runs of one state inside a bucket: one sort of the rows; what follows reads one row per change and bucket
    bucketed = grouped(marked, series).withColumn("__at", F.col(series.time))
    local = series.local()
    gap = f"unix_micros(__at) - unix_micros({{}}) > {(step_seconds or 0) * 1_000_000}"
    changed = f"__was IS NULL OR __was <> __on{f' OR {gap.format("__was_at")}' if step_seconds else ''}"
    runs = bucketed.selectExpr("*", f"lag(__on) {local} AS __was", f"lag(__at) {local} AS __was_at")
    runs = runs.selectExpr("*", f"sum(CAST({changed} AS BIGINT)) {series.local(SO_FAR)} AS __run")
    runs = runs.groupBy(GROUP, "__run").agg(
        F.first("__on").alias("__on"), F.min("__at").alias("__at"), F.max("__at").alias("__until"), F.max("__measure").alias("__measure")
    )
    runs = materialize(runs.selectExpr(*[f"{GROUP}.{k} AS {k}" for k in [*labels, *path]], "__run", "__on", "__at", "__until", "__measure"), "runs")
    # runs of one bucket are few beside its rows, but a cut bucket's runs come in the order of its parts
    order = Series(series.keys, "__at", (*path, "__run"), series.fine, series.coarse)
    marked = previous(runs, order, ["__on", "__until"], prefix="__prev")
    broken = "NOT coalesce(__prev__on, false)"
    if step_seconds:
        broken = f"({broken} OR {gap.format('__prev__until')})"
    numbered = running_total(marked, order, f"CASE WHEN __on AND {broken} THEN 1L ELSE 0L END", "__island")
    stretch = numbered.where("__island > 0").groupBy(*labels, "__island")
    ends = "min(CASE WHEN NOT __on THEN __at END)" if step_seconds is None else "CAST(NULL AS TIMESTAMP)"
    spans = stretch.agg(
        F.expr("min(CASE WHEN __on THEN __at END)").alias("since"),
        F.expr(f"coalesce({ends}, max(CASE WHEN __on THEN __until END))").alias("until"),
        F.expr("max(CASE WHEN __on THEN __measure END)").alias("peak"),
    )
    fires = f"unix_micros(until) - unix_micros(since) >= {hold_seconds * 1_000_000}L AS firing"
    return spans.selectExpr(*labels, "since", "until", "peak", fires)




def latency_alert(quantiles: DataFrame, quantile: str = "p95", limit: float = LATENCY_LIMIT) -> DataFrame:
    """Stretches of slow endpoints; ``quantile`` names the column the rule looks at."""
    hold = HOLD_SECONDS["HighAPILatency"]
    return sustained(quantiles, GRID, f"{quantile} > {limit!r}D", hold, quantile, STEP_SECONDS)


def drift_alert(ratios: DataFrame, series: Series, limit: float = ALERT_RATIO) -> DataFrame:
    """Stretches of high drift; the ratio holds until the next one is set."""
    return sustained(ratios, series, f"drift_ratio > {limit!r}D", HOLD_SECONDS["DataDriftSpike"], "drift_ratio")


def health_alert(health: DataFrame, series: Series) -> DataFrame:
    """Stretches over which a model reports that it is not healthy."""
    return sustained(health, series, "health = 0", HOLD_SECONDS["ModelUnhealthy"], "health")


def error_rate_alert(rates: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Stretches of many errors per second."""
    hold = HOLD_SECONDS["HighErrorRate"]
    return sustained(rates.where("status = 'error'"), GRID, f"rate > {limit!r}D", hold, "rate", STEP_SECONDS)


def firing(stretches: DataFrame, alert: str, label: str) -> DataFrame:
    """Rows of the alert table for the stretches that lasted long enough."""
    return stretches.where("firing").selectExpr(
        f"'{alert}' AS alert", f"'{SEVERITY[alert]}' AS severity", f"{label} AS label", "since", "until", "CAST(peak AS DOUBLE) AS peak"
    )


def alerts(
    quantiles: DataFrame, rates: DataFrame, ratios: DataFrame, health: DataFrame, ratio_series: Series, health_series: Series
) -> DataFrame:
    """All four alert rules in one table."""
    parts = [
        firing(latency_alert(quantiles), "HighAPILatency", "endpoint"),
        firing(drift_alert(ratios, ratio_series), "DataDriftSpike", ratio_series.keys[0]),
        firing(health_alert(health, health_series), "ModelUnhealthy", health_series.keys[0]),
        firing(error_rate_alert(rates), "HighErrorRate", "endpoint"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
