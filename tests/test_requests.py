import datetime as dt

import pytest

from tideframe.operators import requests
from tideframe.plans.ordered import Series

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def gauge(spark, values):
    return spark.createDataFrame([("m", at(s), float(v)) for s, v in values], "model_type string, ts timestamp, v double")


GAUGE = Series(("model_type",), "ts", (), "minute")


def stretches(frame, hold, step=None):
    rows = requests.sustained(frame, GAUGE, "v > 0.3", hold, "v", step).collect()
    return sorted(((r["since"] - START).seconds, (r["until"] - START).seconds, r["peak"], r["firing"]) for r in rows)


def test_condition_held_exactly_long_enough_fires(spark):
    frame = gauge(spark, [(0, 0.1), (60, 0.4), (120, 0.9), (180, 0.2), (240, 0.5), (299, 0.1)])
    assert stretches(frame, 120) == [(60, 180, 0.9, True), (240, 299, 0.5, False)]


def test_open_stretch_ends_with_the_last_sample(spark):
    assert stretches(gauge(spark, [(0, 0.4), (30, 0.4)]), 60) == [(0, 30, 0.4, False)]


def test_value_on_the_limit_and_null_do_not_count(spark):
    frame = gauge(spark, [(0, 0.3)]).selectExpr("model_type", "ts", "v").union(
        spark.createDataFrame([("m", at(10), None)], "model_type string, ts timestamp, v double")
    )
    assert stretches(frame, 0) == []


def test_missing_evaluation_resets(spark):
    frame = gauge(spark, [(s, 0.5) for s in (0, 30, 60, 120, 150)])
    assert stretches(frame, 60, 30) == [(0, 60, 0.5, True), (120, 150, 0.5, False)]


def test_counter_restart(spark):
    frame = gauge(spark, [(0, 5), (30, 8), (60, 2), (90, 2)])
    rows = requests.counter_increase(frame, GAUGE, "v").orderBy("ts").collect()
    assert [r["increase"] for r in rows] == [3.0, 2.0, 0.0]


def log(spark, seconds_and_latency):
    rows = [(i, at(s), "e", "success", lat) for i, (s, lat) in enumerate(seconds_and_latency)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp, endpoint string, status string, latency_s double")


def test_histogram_edges(spark):
    rows = requests.latency_histogram(log(spark, [(0, 0.01), (1, 0.05), (2, 10.0), (3, 11.0)])).collect()
    got = {r["le"]: r["observations"] for r in rows}
    assert (got["0.01"], got["0.05"], got["5"], got["10"], got["+Inf"]) == (1, 2, 2, 3, 4)
    values = [got[f"{b:g}"] for b in requests.REQUEST_BUCKETS]
    assert values == sorted(values)


@pytest.mark.parametrize("q,want", [(0.5, 0.05), (0.25, 0.01), (0.75, 10.0), (0.99, 10.0), (0.375, 0.03)])
def test_bucket_quantile(spark, q, want):
    row = requests.latency_quantiles(log(spark, [(0, 0.01), (1, 0.05), (2, 10.0), (3, 11.0)]), quantiles=[q]).first()
    assert row[f"p{round(q * 100)}"] == pytest.approx(want)


def test_ranges_are_half_open(spark):
    rates = requests.counter_rate(log(spark, [(0, 1.0), (30, 1.0)])).orderBy("window_end").collect()
    ends = [(r["window_end"] - START).seconds for r in rates]
    assert ends == list(range(30, 331, 30))
    assert [round(r["rate"] * 300) for r in rates] == [1] + [2] * 9 + [1]


def test_active_requests_at_shared_instants(spark):
    rows = [(0, at(0), at(10)), (1, at(10), at(20)), (2, at(5), at(5))]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, end_ts timestamp")
    got = {(r["ts"] - START).seconds: r["active"] for r in requests.active_requests(frame).collect()}
    assert got == {0: 1, 5: 1, 10: 1, 20: 0}
