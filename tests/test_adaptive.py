"""Buckets that follow the data, gauges on a grid, and the value set last."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest

from tideframe.operators import requests
from tideframe.plans.adaptive import PATH, cut_full_buckets
from tideframe.plans.ordered import GROUP, Series, forward_fill, grouped, ordinal, previous, running_total

START = dt.datetime(2024, 1, 1)
LOG = Series(("k",), "ts", ("id",), "second", "day")


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def skewed(spark, rows=4000, seed=3):
    """Nine tenths of the rows in one second of one key, a third of these in one instant; some keys and times missing."""
    rng = np.random.default_rng(seed)
    out = []
    for i in rng.permutation(rows).tolist():
        hot = i % 10 < 9
        second = 40.5 if hot and i % 3 == 0 else 40 + int(rng.integers(0, 900)) / 1000 if hot else float(rng.integers(0, 5000))
        out.append((None if i % 211 == 0 else "a" if hot else "b", None if i % 97 == 0 else at(second), i, None if i % 5 else float(i)))
    return spark.createDataFrame(out, "k string, ts timestamp, id long, v double").repartition(7), out


def in_order(rows):
    series = {}
    for k, ts, i, v in rows:
        series.setdefault(k, []).append((ts is None, ts or START, i, v))
    return {k: sorted(found) for k, found in series.items()}


@pytest.mark.parametrize("most", [50, 400])
def test_no_bucket_exceeds_the_bound_and_results_stay(spark, most):
    frame, rows = skewed(spark)
    cut, series = cut_full_buckets(frame, LOG, most)
    cut = cut.persist()
    assert cut.count() == len(rows) and cut.columns == [*frame.columns, PATH]
    sizes = [r["count"] for r in grouped(cut, series).groupBy(GROUP).count().collect()]
    assert max(sizes) <= most
    assert max(r["count"] for r in grouped(frame, LOG).groupBy(GROUP).count().collect()) > 1000
    want = in_order(rows)
    numbers = {r.id: r.n for r in running_total(cut, series, "1L", "n").collect()}
    places = {r.id: (r.position, r.size) for r in ordinal(cut, series, size="size").collect()}
    filled = {r.id: r.v for r in forward_fill(cut, series, ["v"]).collect()}
    before = {r.id: r.prev_id for r in previous(cut, series, ["id"]).collect()}
    for found in want.values():
        last, prev = None, None
        for n, (_, _, i, v) in enumerate(found, 1):
            last = v if v is not None else last
            assert (numbers[i], places[i], filled[i], before[i]) == (n, (n - 1, len(found)), last, prev)
            prev = i
    cut.unpersist()


def test_rows_that_nothing_orders_stay_together(spark):
    frame = spark.createDataFrame([("a", at(1), 7)] * 30 + [("a", at(2), i) for i in range(30)], "k string, ts timestamp, id long")
    cut, series = cut_full_buckets(frame, LOG, 10)
    sizes = Counter(r["count"] for r in grouped(cut, series).groupBy(GROUP).count().collect())
    assert sizes[30] == 1 and max(s for s in sizes if s != 30) <= 10


def test_even_buckets_are_left_alone_and_empty_tables_pass(spark):
    frame = spark.createDataFrame([("a", at(i), i) for i in range(40)], "k string, ts timestamp, id long")
    for rows in (frame, frame.limit(0)):
        cut, series = cut_full_buckets(rows, LOG, 10)
        assert {tuple(r[PATH]) for r in cut.collect()} <= {()}
        assert running_total(cut, series, "1L", "n").count() == rows.count()


def test_far_apart_numbers(spark):
    ids = [-(2**63), 2**63 - 1, 0, 1, 2, 3, -5, 2**62, None]
    frame = spark.createDataFrame([("a", at(1), i) for i in ids], "k string, ts timestamp, id long")
    cut, series = cut_full_buckets(frame, LOG, 2)
    assert max(r["count"] for r in grouped(cut, series).groupBy(GROUP).count().collect()) <= 2
    found = {r.id: r.position for r in ordinal(cut, series).collect()}
    assert [i for i, _ in sorted(found.items(), key=lambda x: x[1])] == [None, *sorted(i for i in ids if i is not None)]


def test_stretches_of_a_cut_series(spark):
    frame, _ = skewed(spark)
    plain = requests.sustained(frame, LOG, "v > 1000", 0, "v")
    cut, series = cut_full_buckets(frame, LOG, 100)
    key = lambda f: sorted(map(str, f.collect()))
    assert key(requests.sustained(cut, series, "v > 1000", 0, "v")) == key(plain)


def grid(spark, rows, **options):
    frame = spark.createDataFrame(rows, "model_type string, ts timestamp, event_id long, v double")
    return sorted(((r.instant - START).total_seconds(), r.v) for r in requests.gauge_on_grid(frame, ["model_type"], "v", **options).collect())


def test_grid_sees_values_of_the_last_five_minutes(spark):
    found = grid(spark, [("m", at(10), 1, 0.5), ("m", at(90), 2, 0.7), ("m", at(1000), 3, 0.1), ("m", None, 4, 9.0)])
    assert found == [(30 * i, 0.5) for i in range(1, 3)] + [(30 * i, 0.7) for i in range(3, 13)] + [(30.0 * i, 0.1) for i in range(34, 44)]


def test_grid_ties_and_null_values(spark):
    assert grid(spark, [("m", at(30), 2, 0.2), ("m", at(30), 1, 0.9), ("m", at(60), 3, None)], look_back=60) == [(30, 0.2), (60, None), (90, None)]


def test_gap_longer_than_the_limit_ends_a_stretch(spark):
    frame = spark.createDataFrame([("m", at(0), 1, 0.5), ("m", at(500), 2, 0.5)], "model_type string, ts timestamp, event_id long, v double")
    rows = requests.grid_alert(requests.gauge_on_grid(frame, ["model_type"], "v"), ["model_type"], "v > 0.3", 240, "v").collect()
    assert sorted((r.since, r.until, r.firing) for r in rows) == [(at(0), at(270), True), (at(510), at(780), True)]


def test_as_of_join(spark):
    series = Series(("k",), "ts", ("id",), "minute")
    events = spark.createDataFrame([("a", at(s), i) for i, s in enumerate([0, 10, 10, 200])] + [("b", at(5), 9), (None, at(50), 10), ("a", None, 11)], "k string, ts timestamp, id long")
    events = events.selectExpr("*", "'x' AS `my col`", "1 AS v")
    settings = spark.createDataFrame(
        [("a", at(10), 5, 1.0), ("a", at(10), 6, 2.0), ("a", at(100), 1, None), ("a", at(150), 1, 3.0), (None, at(1), 1, 7.0), ("a", None, 1, 99.0)], "k string, ts timestamp, id long, r double"
    )
    found = {r.id: (r.r, r["my col"], r.v) for r in requests.as_of_join(events, settings, series, ["r"]).collect()}
    assert {i: r for i, (r, _, _) in found.items()} == {0: None, 1: 2.0, 2: 2.0, 3: 3.0, 9: None, 10: 7.0, 11: None}
    assert {x[1:] for x in found.values()} == {("x", 1)}
    null_set = requests.as_of_join(spark.createDataFrame([("a", at(120), 1)], "k string, ts timestamp, id long"), settings, series, ["r"]).first()
    assert null_set.r is None
    assert requests.as_of_join(events.limit(0), settings, series, ["r"]).count() == 0
    assert requests.as_of_join(events, settings.limit(0), series, ["r"]).where("r IS NULL").count() == 7
