"""Feature values against pandas on seeded walks, and the block technique against whole series."""

import numpy as np
import pandas as pd
import pytest

from tideframe.operators import clean, features
from tideframe.plans.blocks import Columns, in_blocks
from tideframe.plans.ordered import HOURLY

BASE = ["price", "market_cap", "total_volume"]


def circle(out, label, value, period):
    out[f"{label}_sin"], out[f"{label}_cos"] = np.sin(2 * np.pi * value / period), np.cos(2 * np.pi * value / period)


def expected_full(g: pd.DataFrame) -> pd.DataFrame:
    """Full set of one cleaned series, column by column."""
    d = g.copy()
    t, p, v = d.index, d["price"], d["total_volume"]
    d["hour"], d["day"], d["day_of_week"] = t.hour, t.day, t.dayofweek
    d["month"], d["quarter"], d["year"] = t.month, t.quarter, t.year
    circle(d, "hour", d["hour"], 24)
    circle(d, "day", d["day_of_week"], 7)
    circle(d, "month", d["month"], 12)
    d["hours_since_start"] = (t - t.min()).total_seconds() / 3600
    for c in BASE:
        for k in (1, 3, 6, 12, 24):
            d[f"{c}_lag_{k}h"] = g[c].shift(k)
        for w in (3, 6, 12, 24, 48):
            r = g[c].rolling(w)
            for label, s in (("mean", r.mean()), ("std", r.std()), ("min", r.min()), ("max", r.max())):
                d[f"{c}_rolling_{label}_{w}h"] = s
    for k in (1, 3, 6, 24):
        d[f"price_change_{k}h"], d[f"price_pct_change_{k}h"] = p.diff(k), p.pct_change(k)
    for k in (6, 24):
        d[f"volatility_{k}h"] = p.pct_change().rolling(k).std()
        d[f"momentum_{k}h"] = p / p.shift(k) - 1
        d[f"volume_ma_{k}h"] = v.rolling(k).mean()
        d[f"volume_ratio_{k}h"] = v / v.rolling(k).mean()
        d[f"price_above_sma_{k}h"] = (p > p.rolling(k).mean()).astype(int)
    low, high = p.rolling(24).min(), p.rolling(24).max()
    d["price_position_24h"] = (p - low) / (high - low)
    for k in (1, 6, 24):
        d[f"volume_change_{k}h"] = v.pct_change(k)
    d["price_volume_corr_24h"] = p.rolling(24).corr(v)
    for k in (6, 12, 24):
        d[f"sma_{k}h"], d[f"ema_{k}h"] = p.rolling(k).mean(), p.ewm(span=k).mean()
    mid, dev = p.rolling(20).mean(), p.rolling(20).std()
    d["bollinger_upper"], d["bollinger_lower"], d["bollinger_width"] = mid + 2 * dev, mid - 2 * dev, 4 * dev
    return d.dropna()


def expected_compact(g: pd.DataFrame) -> pd.DataFrame:
    d = g.copy()
    t, p, v = d.index, d["price"], d["total_volume"]
    d["hour"], d["day_of_week"] = t.hour, t.dayofweek
    circle(d, "hour", d["hour"], 24)
    circle(d, "day", d["day_of_week"], 7)
    for k in (1, 3, 6, 12, 24):
        d[f"price_lag_{k}h"], d[f"volume_lag_{k}h"] = p.shift(k), v.shift(k)
        d[f"price_change_{k}h"] = p.pct_change(k)
    for w in (3, 6, 12, 24):
        r = p.rolling(w)
        for label, s in (("mean", r.mean()), ("std", r.std()), ("min", r.min()), ("max", r.max())):
            d[f"price_rolling_{label}_{w}h"] = s
        d[f"volume_rolling_mean_{w}h"] = v.rolling(w).mean()
    for k in (3, 6, 12):
        d[f"momentum_{k}h"] = p - p.shift(k)
    for k in (6, 12, 24):
        d[f"volatility_{k}h"] = p.pct_change().rolling(k).std()
        d[f"sma_{k}h"] = p.rolling(k).mean()
    d["ema_6h"], d["ema_12h"] = p.ewm(span=6).mean(), p.ewm(span=12).mean()
    d["volume_price_ratio"], d["volume_change_1h"] = v / p, v.pct_change(1)
    mid, dev = p.rolling(12).mean(), p.rolling(12).std()
    d["bb_middle"], d["bb_upper"], d["bb_lower"] = mid, mid + 2 * dev, mid - 2 * dev
    d["bb_width"] = (d["bb_upper"] - d["bb_lower"]) / mid
    d["price_bb_position"] = (p - d["bb_lower"]) / (d["bb_upper"] - d["bb_lower"])
    return d.dropna()


def per_coin(raw: pd.DataFrame, build) -> pd.DataFrame:
    parts = []
    for coin, g in raw.groupby("coin_id"):
        g = g.sort_values("ingest_seq").set_index("timestamp")[BASE]
        parts.append(build(g).assign(coin_id=coin).reset_index())
    return pd.concat(parts, ignore_index=True)


def cleaned(g):
    return g[~g.index.duplicated(keep="first")].sort_index().ffill().dropna()


def strict(g):
    g = g.dropna()
    return g[~g.index.duplicated(keep="first")].sort_index()


def assert_same(got: pd.DataFrame, want: pd.DataFrame, rtol=1e-9):
    assert set(got.columns) == set(want.columns)
    keys = ["coin_id", "timestamp"]
    a = got.sort_values(keys).reset_index(drop=True)
    b = want.sort_values(keys).reset_index(drop=True)
    assert len(a) == len(b)
    assert (a["timestamp"].astype("datetime64[us]") == b["timestamp"].astype("datetime64[us]")).all()
    for c in a.columns.difference(keys):
        x, y = a[c].astype(float), b[c].astype(float)
        # a level of 1e11 leaves about 1e-5 of rounding in differences of it
        atol = 1e-9 if c.endswith(("corr_24h", "_sin", "_cos")) or "volatility" in c or "change" in c else 1e-7
        np.testing.assert_allclose(x, y, rtol=max(rtol, 1e-6 if "_std_" in c else rtol), atol=atol, err_msg=c)


def test_full_set_equals_pandas(spark, walk):
    raw = walk(200)
    got = features.full_features(spark.createDataFrame(raw)).toPandas()
    assert len(got.columns) == 125
    assert_same(got, per_coin(raw, lambda g: expected_full(cleaned(g))))


def test_full_set_with_gaps_duplicates_and_leading_nulls(spark, walk):
    raw = walk(150, gaps=True)
    raw.loc[raw["timestamp"] < "2022-01-01 03:00", "market_cap"] = np.nan
    raw.loc[raw.index % 11 == 3, "price"] = np.nan
    again = raw.iloc[::7].assign(price=1.0, ingest_seq=lambda d: d["ingest_seq"] + 10_000)
    raw = pd.concat([raw, again], ignore_index=True)
    got = features.full_features(spark.createDataFrame(raw)).toPandas()
    assert_same(got, per_coin(raw, lambda g: expected_full(cleaned(g))))


def test_compact_set_equals_pandas(spark, walk):
    raw = walk(120)
    raw.loc[raw.index % 13 == 5, "total_volume"] = np.nan
    got = features.compact_features(spark.createDataFrame(raw)).toPandas()
    assert len(got.columns) == 64
    assert_same(got, per_coin(raw, lambda g: expected_compact(strict(g))))


def test_many_blocks_equal_one_series(spark, walk):
    """Blocks of 512 rows cross every kind of frame; the values are those of the undivided series."""
    raw = walk(1700, coins=("a",))
    got = features.full_features(spark.createDataFrame(raw), rows=512).toPandas()
    assert_same(got, per_coin(raw, lambda g: expected_full(cleaned(g))))


def test_small_margin_blocks(spark, walk):
    raw = walk(1300, coins=("a", "b")).drop(columns="ingest_seq")
    got = features.add_lag_features(spark.createDataFrame(raw), lags=(1, 24), rows=512).toPandas()
    want = raw.sort_values("timestamp").copy()
    for c in BASE:
        for k in (1, 24):
            want[f"{c}_lag_{k}h"] = want.groupby("coin_id")[c].shift(k)
    assert_same(got, want)


def test_series_shorter_than_the_longest_window_is_empty(spark, walk):
    raw = walk(47, coins=("a",))
    assert features.full_features(spark.createDataFrame(raw)).count() == 0
    raw = walk(50, coins=("a",))
    assert features.full_features(spark.createDataFrame(raw)).count() == 3


def test_flat_series_has_no_position_or_correlation(spark, walk):
    raw = walk(60, coins=("a",)).assign(price=5.0).drop(columns="ingest_seq")
    frame = spark.createDataFrame(raw)
    changed = features.add_price_change_features(frame).toPandas()
    assert changed["price_position_24h"].isna().all()
    volume = features.add_volume_features(frame).toPandas()
    assert volume["price_volume_corr_24h"].isna().all()


def test_zero_price_gives_infinity_and_empty_volatility(spark):
    hours = pd.date_range("2022-01-01", periods=12, freq="h")
    prices = [1.0, 2.0, 0.0, 0.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    raw = pd.DataFrame({"coin_id": "a", "timestamp": hours, "price": prices})
    got = features.add_price_change_features(spark.createDataFrame(raw)).toPandas().sort_values("timestamp")
    change = got["price_pct_change_1h"].tolist()
    assert change[2] == -1.0
    assert np.isnan(change[3])  # 0 / 0
    assert change[4] == np.inf
    assert got["volatility_6h"].isna().tolist() == [True] * 10 + [False] * 2


def test_percent_change_fills_gaps_but_difference_does_not(spark):
    hours = pd.date_range("2022-01-01", periods=3, freq="h")
    rows = [("a", t.to_pydatetime(), v) for t, v in zip(hours, [1.0, None, 4.0])]
    frame = spark.createDataFrame(rows, "coin_id string, timestamp timestamp, price double")
    rows = features.add_price_change_features(frame).orderBy("timestamp").collect()
    assert [r["price_pct_change_1h"] for r in rows] == [None, 0.0, 3.0]
    assert [r["price_change_1h"] for r in rows] == [None, None, None]


def test_missing_source_columns_are_skipped(spark, walk):
    frame = spark.createDataFrame(walk(30).drop(columns=["total_volume", "ingest_seq"]))
    assert features.add_volume_features(frame).columns == frame.columns
    assert "total_volume_lag_1h" not in features.add_lag_features(frame).columns


@pytest.mark.parametrize("span", [1, 1.5, 3, 6, 24, 26, 200])
@pytest.mark.parametrize("gap", [0, 1700])
def test_ewma_ages_weights_over_nulls(spark, span, gap):
    rng = np.random.default_rng(1)
    n = 1400 + gap
    values = pd.Series(rng.normal(size=n) * 10 + 100)
    values[rng.uniform(size=n) < 0.2] = np.nan
    values[300 : 300 + gap] = np.nan
    hours = pd.date_range("2022-01-01", periods=n, freq="h")
    raw = pd.DataFrame({"coin_id": "a", "timestamp": hours, "price": values})
    frame = spark.createDataFrame(raw).selectExpr("coin_id", "timestamp", "nanvl(price, null) price")
    got = features.add_ewma_features(frame, spans=[span], rows=512).toPandas().sort_values("timestamp")
    np.testing.assert_allclose(got[f"price_ewma_{str(span).replace('.', '_')}h"], values.ewm(span=span).mean(), rtol=1e-9)


def test_spans_below_one_are_refused():
    with pytest.raises(ValueError):
        Columns(HOURLY, ["price"]).ewma("price", 0.5)


def test_rows_without_key_or_time_stay(spark):
    rows = [("a", "2022-01-01 00:00:00", 1.0), (None, "2022-01-01 01:00:00", 2.0), (None, "2022-01-02 01:00:00", None), ("a", None, 4.0), (None, None, 5.0)]
    frame = spark.createDataFrame(rows, "coin_id string, timestamp string, price double").selectExpr("coin_id", "CAST(timestamp AS TIMESTAMP) timestamp", "price")
    lagged = {(r.coin_id, str(r.timestamp)): r.price_lag_1h for r in features.add_lag_features(frame, columns=["price"], lags=[1]).collect()}
    assert lagged == {
        ("a", "2022-01-01 00:00:00"): None, ("a", "None"): 1.0,
        (None, "2022-01-01 01:00:00"): None, (None, "2022-01-02 01:00:00"): 2.0, (None, "None"): None,
    }


def test_invariants(spark, walk):
    got = features.full_features(spark.createDataFrame(walk(150))).toPandas()
    for w in (3, 6, 12, 24, 48):
        low, mean, high = (got[f"price_rolling_{s}_{w}h"] for s in ("min", "mean", "max"))
        assert ((low <= mean + 1e-9) & (mean <= high + 1e-9)).all()
    np.testing.assert_allclose(got["sma_24h"], got["price_rolling_mean_24h"])
    assert got["hour_sin"].between(-1, 1).all()


def test_plan_sorts_once_for_all_windows(spark, walk):
    """One shuffle and one sort serve all windows over blocks; every partitioning names a bucket or block."""
    frame = features.add_rolling_features(spark.createDataFrame(walk(60).drop(columns="ingest_seq")))
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    physical = frame._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in physical.splitlines() if "Sort [coin_id" in line and "__block" in line]) == 1
    assert all(any(n in w for n in ("__block", "__bucket", "__group")) for w in windows)


def test_blocks_keep_input_columns(spark, walk):
    frame = spark.createDataFrame(walk(30))
    out = in_blocks(frame, HOURLY, lambda p: {"x": p.lag("price", 1)})
    assert out.columns == [*frame.columns, "x"]
    assert out.count() == frame.count()


def test_clean_keeps_first_delivery(spark):
    rows = [("a", "2022-01-01 01:00", 2.0, 5), ("a", "2022-01-01 01:00", 9.0, 7), ("a", "2022-01-01 00:00", None, 6)]
    frame = spark.createDataFrame(rows, "coin_id string, t string, price double, ingest_seq bigint")
    frame = frame.selectExpr("coin_id", "CAST(t AS TIMESTAMP) timestamp", "price", "ingest_seq")
    assert [r["price"] for r in clean.clean_series(frame).collect()] == [2.0]
    with pytest.raises(ValueError):
        clean.dedupe_first(frame.drop("ingest_seq"))


def test_filters_on_finished_features_plan_quickly(spark, walk):
    """A filter above the complete-rows test must not blow up constraint inference."""
    got = features.full_features(spark.createDataFrame(walk(80, coins=("a",))))
    assert got.where("timestamp >= TIMESTAMP '2022-01-04'").count() == 8
