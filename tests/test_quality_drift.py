import numpy as np
import pandas as pd
import pytest

from tideframe.functions.numeric import null_safe_doubles
from tideframe.operators import drift, profile, publish, quality


@pytest.fixture()
def good(spark, walk):
    return spark.createDataFrame(walk(100, coins=("a",)).drop(columns="ingest_seq"))


def test_good_frame_passes(good):
    report = quality.quality_report(good, as_of="2022-01-05 04:00:00").first()
    assert (report["rows"], report["overall_status"], report["failed_columns"]) == (100, "PASSED", "")
    assert report["fresh"] and report["complete"] and report["completeness_ratio"] == 1.0
    quality.enforce_quality(good)
    quality.enforce_gate(good)


def test_stale_or_incomplete_series_still_passes(good):
    sparse = good.where("hour(timestamp) % 3 = 0")
    report = quality.quality_report(sparse, as_of="2023-01-01 00:00:00").first()
    assert not report["fresh"] and not report["complete"]
    assert report["overall_status"] == "PASSED"


def test_columns_of_any_name(spark):
    names = ["my col", "a.b", "a:b", "tick`mark", "it's", "back\\slash"]
    frame = spark.createDataFrame([(1, None, 2, None, 3, 4), (None, None, 1, 1, 1, 1)], ", ".join(f"`{n.replace('`', '``')}` int" for n in names))
    assert {r.column_name: r.null_count for r in quality.null_check(frame).collect()} == dict(zip(names, [1, 2, 0, 1, 0, 0]))
    assert {r.column_name: r.status for r in quality.schema_check(frame, names[:2] + ["gone"]).collect()} == dict.fromkeys(names[2:], "extra") | dict.fromkeys(names[:2], "present") | {"gone": "missing"}


def test_nulls_fail_before_schema(good):
    holes = good.selectExpr("*").withColumn("price", good["price"]).selectExpr(
        "coin_id", "timestamp", "CASE WHEN timestamp >= TIMESTAMP '2022-01-01 06:00:00' THEN price END AS price", "market_cap"
    )
    with pytest.raises(quality.DataQualityError, match="null percentage"):
        quality.enforce_quality(holes)
    with pytest.raises(quality.DataQualityError, match="missing required"):
        quality.enforce_quality(good.drop("total_volume"))
    row = quality.null_check(holes, ["price"]).first()
    assert (row["null_count"], row["null_percentage"], row["failed"]) == (6, 6.0, True)


def test_gate_collects_every_issue(good):
    bad = good.limit(5).selectExpr("coin_id", "timestamp", "'x' AS price", "CAST(NULL AS DOUBLE) AS market_cap")
    with pytest.raises(quality.DataQualityError) as error:
        quality.enforce_gate(bad)
    for part in ("schema total_volume", "numeric price", "nulls market_cap", "rows"):
        assert part in str(error.value)


def test_ranges(spark):
    hours = pd.date_range("2022-01-01", periods=4, freq="h")
    pdf = pd.DataFrame({"coin_id": "a", "timestamp": hours, "price": [100.0, np.nan, 151.0, -1.0], "market_cap": 1.0, "total_volume": [1.0, 0.0, np.nan, -1.0]})
    row = quality.range_check(null_safe_doubles(spark.createDataFrame(pdf))).first()
    # the gap is filled before changes are taken, so 100 -> 151 counts, and so does 151 -> -1
    assert (row["negative_prices"], row["invalid_volumes"], row["extreme_changes"], row["ranges_valid"]) == (1, 2, 2, False)


def test_types_of_text_columns(spark):
    frame = spark.createDataFrame([("1.5", "x", "2022-01-01", "7"), (None, "2", "later", "8")], "price string, market_cap string, timestamp string, total_volume string")
    bad = {r["column_name"]: r["bad_cells"] for r in quality.type_check(frame).collect()}
    assert bad == {"price": 0, "market_cap": 1, "total_volume": 0, "timestamp": 1}


def test_bounds_prefer_the_observed_range(spark):
    stats = spark.createDataFrame([("a", 10.0, 2.0, 7.0, None), ("b", 0.0, 1.0, None, 2.0)], "feature string, mean double, std double, min double, max double")
    bounds = drift.collect_bounds(drift.drift_bounds(stats))
    assert bounds == {"a": (7.0, 16.0), "b": (-3.0, 2.0)}


def test_flags_and_ratio(spark):
    frame = spark.createDataFrame([("k", 7.0, 2.0, 1.0), ("l", 6.9, 2.1, None), ("m", None, 5.0, 0.0)], "id string, a double, b double, unknown double")
    bounds = {"a": (7.0, 16.0), "b": (-3.0, 2.0)}
    table = spark.createDataFrame([(f, *b) for f, b in bounds.items()], "feature string, low double, high double")
    features = ["a", "b", "unknown"]
    flags = drift.drift_flags(frame, table, features, ["id"])
    got = {(r["id"], r["feature"]): r["is_drift"] for r in flags.collect()}
    assert {k for k, v in got.items() if v} == {("l", "a"), ("l", "b"), ("m", "b")}
    assert len(got) == 9
    ratio = {r["id"]: r["drift_ratio"] for r in drift.drift_ratio(frame, bounds, features).collect()}
    assert ratio == {"k": 0.0, "l": 2 / 3, "m": 1 / 3}
    assert {r["drift_ratio"] for r in drift.drift_ratio(frame, {}, features).collect()} == {0.0}
    counted = drift.drift_detections(flags, ["feature"]).collect()
    assert {r["feature"]: r["detections"] for r in counted} == {"a": 1, "b": 2}


def test_training_stats_skip_empty_and_absent_features(spark):
    frame = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, 6.0)], "a double, empty double, price double")
    stats = drift.training_stats(frame, ["a", "empty", "gone"]).collect()
    assert [(r["feature"], r["mean"], r["median"], r["q25"]) for r in stats] == [("a", 2.0, 2.0, 1.5)]
    assert drift.drift_features(frame) == ["a", "empty"]


def test_check_file(spark, walk, tmp_path):
    rows = walk(48, coins=("a",)).sort_values("timestamp")[["timestamp", "price", "market_cap", "total_volume"]]
    publish.write_csv(spark.createDataFrame(rows).coalesce(1), str(tmp_path / "good"))
    row = quality.check_file(spark, str(tmp_path / "good"), as_of="2022-01-02 23:00:00").first()
    assert row["overall_status"] == "PASSED" and row["rows"] == 48
    rows.loc[rows.index[:5], "price"] = None
    publish.write_csv(spark.createDataFrame(rows).selectExpr("timestamp", "nanvl(price, NULL) AS price", "market_cap", "total_volume"), str(tmp_path / "bad"))
    with pytest.raises(quality.DataQualityError):
        quality.check_file(spark, str(tmp_path / "bad"))
    with pytest.raises(Exception):
        quality.check_file(spark, str(tmp_path / "none"))


def test_profile_report_has_all_parts(spark, walk):
    frame = spark.createDataFrame(walk(30).drop(columns="ingest_seq"))
    report = profile.profile_report(frame, ["timestamp", "coin_id"], ["price", "market_cap"], size=3)
    assert {n: f.count() for n, f in report.items()} == {
        "summary": 1, "statistics": 2, "missing": 0, "correlations": 1, "duplicates": 0, "samples": 9,
    }
