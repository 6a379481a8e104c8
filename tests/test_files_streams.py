import datetime as dt
import json
import os

import pandas as pd
import pytest

from compare import difference
from tideframe.operators import features, publish, requests
from tideframe.session import new_path
from tideframe.sources import files
from tideframe.sources.tables import events, request_log
from tideframe.streaming import alerts, ingest, metrics

HOUR, START = 3_600_000, 1_710_504_000_000


def payload(spark, tmp_path, **changes):
    times = [START + HOUR * i + 977 * i * i for i in range(7)]  # irregular
    doc = {
        "prices": [[t, 3.5 + 2 * i] for i, t in enumerate(times)],
        "market_caps": [[t, 800.0 - i] for i, t in enumerate(times)],
        "total_volumes": [[t, 15.25 * i] for i, t in enumerate(times)],
    } | changes
    path = tmp_path / "payload.json"
    path.write_text(json.dumps(doc, indent=1))
    return files.read_market_chart(spark, str(path), keys="", multi_line=True)


def test_flatten(spark, tmp_path):
    rows = files.flatten_market_chart(payload(spark, tmp_path)).orderBy("timestamp").collect()
    assert len(rows) == 7 and rows[0]["timestamp"] == dt.datetime(2024, 3, 15, 12)
    assert rows[2]["timestamp"] == dt.datetime(2024, 3, 15, 14, 0, 3, 908000)
    assert (rows[3]["price"], rows[3]["market_cap"], rows[3]["total_volume"]) == (9.5, 797.0, 45.75)


def test_flatten_null_items_ragged_and_empty(spark, tmp_path):
    holes = [None] * 7
    rows = files.flatten_market_chart(payload(spark, tmp_path, market_caps=holes)).collect()
    assert all(r["market_cap"] is None for r in rows) and len(rows) == 7
    with pytest.raises(Exception, match="empty item"):
        files.flatten_market_chart(payload(spark, tmp_path, market_caps=holes), strict=True).collect()
    with pytest.raises(Exception, match="differ in length"):
        files.flatten_market_chart(payload(spark, tmp_path, total_volumes=[[1, 2]])).collect()
    empty = payload(spark, tmp_path, prices=[], market_caps=[], total_volumes=[])
    with pytest.raises(ValueError, match="no price at all"):
        files.require_prices(empty)
    assert files.without_prices(empty).count() == 1


def test_time_range_and_lookup(spark, walk):
    frame = spark.createDataFrame(walk(72, coins=("a",)))
    assert publish.time_range(frame, end="2022-01-02").count() == 25  # a date is its midnight
    assert publish.time_range(frame, start="2022-01-02", end="2022-01-02 02:00:00").count() == 3
    for start, end in (("2022-01-02", "2022-01-02"), ("2022-01-02 10:00:00", "2022-01-02 9:00:00")):
        with pytest.raises(ValueError):
            publish.time_range(frame, start=start, end=end)
    assert publish.time_range(frame, start="2022-01-02 9:00:00", end="2022-01-02 10:00:00").count() == 2
    with pytest.raises(ValueError):
        publish.at_time(frame, "2030-01-01")
    assert publish.at_time(frame, "2022-01-01 05:00:00").count() == 1


def test_publish_verifies_and_falls_back(spark, walk, tmp_path):
    frame = spark.createDataFrame(walk(40))
    row = publish.publish_dataset(frame, str(tmp_path / "store"), "x", "1").first()
    assert row["verified"] and row["rows"] == 80 and row["key"] == "processed/1_x"
    with pytest.raises(Exception):
        publish.publish_dataset(frame, str(tmp_path / "store"), "x", "1")
    again = publish.publish_with_fallback(frame, str(tmp_path / "store"), str(tmp_path / "backup"), "x", "1").first()
    assert again["fallback"] and again["verified"]


def test_fingerprint_sees_duplicates_but_not_order(spark, walk):
    frame = spark.createDataFrame(walk(40))
    base = publish.table_fingerprint(frame).first()
    assert publish.table_fingerprint(frame.orderBy("price").repartition(3)).first() == base
    assert publish.table_fingerprint(frame.union(frame)).first()["digest"] != base["digest"]


def test_fingerprint_sees_where_nulls_are(spark, tmp_path):
    schema = "a int, b int, `odd name` string"
    one = spark.createDataFrame([(1, None, ""), (2, 3, None)], schema)
    other = spark.createDataFrame([(None, 1, ""), (2, 3, None)], schema)
    moved = spark.createDataFrame([(1, None, None), (2, 3, "")], schema)
    digests = {publish.table_fingerprint(f).first()["digest"] for f in (one, other, moved)}
    assert len(digests) == 3
    row = publish.publish_dataset(one, str(tmp_path), "x", "1").first()
    assert row["verified"] and row["digest"] == publish.table_fingerprint(one).first()["digest"]


def test_manifest_and_report(spark, tmp_path):
    frame = spark.createDataFrame([(i, str(i)) for i in range(20)], "a int, b string")
    frame.repartitionByRange(3, "a").write.parquet(str(tmp_path / "data"))
    stored = spark.read.parquet(str(tmp_path / "data"))
    files_ = publish.content_manifest(stored).collect()
    assert len(files_) == 3 and sum(r["rows"] for r in files_) == 20
    whole = [sum(int(r["digest"].split("-")[k]) for r in files_) for k in (0, 1)]
    assert publish.table_fingerprint(frame).first()["digest"] == f"{whole[0]}-{whole[1]}"
    path = publish.write_report(spark.range(1), str(tmp_path / "report"))
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 1


def test_stats_document_roundtrip(spark, tmp_path):
    stats = spark.createDataFrame([("a", *[float(i) for i in range(7)])], files.STATS_SCHEMA)
    path = publish.write_report(stats, str(tmp_path / "stats"))
    assert files.read_stats(spark, path).collect() == stats.collect()


def _in_time_order(spark, folder, path, parts=6):
    """The event table as files that arrive in time order."""
    rows = spark.read.parquet(f"{folder}/events.parquet").toPandas().sort_values("ts")
    for i in range(parts):
        part = rows.iloc[i * len(rows) // parts : (i + 1) * len(rows) // parts]
        part.astype({"ts": "datetime64[us]"}).to_parquet(f"{path}/{i}.parquet")
        os.utime(f"{path}/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def test_streams_equal_batch(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    _in_time_order(spark, folder, tmp_path)
    log = request_log(metrics.event_stream(spark, str(tmp_path), files_per_trigger=1))
    batch_log = request_log(events(spark, folder))
    rates = metrics.counter_rate(log, batch_log).toPandas()
    assert difference(rates, requests.counter_rate(batch_log).toPandas()) is None
    got = requests.quantiles_of(metrics.histogram_ranges(log, batch_log), ["endpoint"]).toPandas()
    assert difference(got, requests.latency_quantiles(batch_log).toPandas(), atol=1e-12) is None


def test_stream_alerts_equal_batch(spark, tmp_path):
    """Files in time order, several batches; the last stretch is open when the input ends."""
    _in_time_order(spark, "/root/testdata/sf0.001", tmp_path, 3)
    log = request_log(metrics.event_stream(spark, str(tmp_path), files_per_trigger=1))
    rates = requests.counter_rate(request_log(events(spark, "/root/testdata/sf0.001")))
    got = alerts.drain(log, lambda rows: alerts.error_rate_alert(rows, 0.003), {"status": "'error'"}).toPandas()
    want = requests.error_rate_alert(rates, 0.003).toPandas()
    assert len(want) > 20 and difference(got, want) is None
    last = rates.where("status = 'error'").toPandas()["window_end"].max()
    assert last in set(got["until"])


def test_request_counts_run_on_a_stream(spark, tmp_path):
    _in_time_order(spark, "/root/testdata/sf0.001", tmp_path, 3)
    counts = requests.request_counts(request_log(metrics.event_stream(spark, str(tmp_path), 1)))
    query = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    want = requests.request_counts(request_log(events(spark, "/root/testdata/sf0.001"))).toPandas()
    assert difference(spark.table("counts").toPandas(), want) is None


@pytest.mark.parametrize("late", ["2022-01-20", "2022-01-01"])
def test_late_rows_correct_features(spark, walk, tmp_path, late):
    raw = walk(1500)
    raw["ingest_seq"] = range(len(raw))
    window = raw["timestamp"].between(late, pd.Timestamp(late) + pd.Timedelta(hours=30)) & (raw["coin_id"] == "a")
    cut = raw["timestamp"] < "2022-02-20"
    again = raw[cut & ~window].head(50).assign(price=1.0, ingest_seq=10_000)  # later deliveries of known hours lose
    hole = raw[window].assign(price=None, ingest_seq=-1)  # incomplete rows never count
    write = ingest.correcting_writer(str(tmp_path / "history"), str(tmp_path / "features"))
    parts = [pd.concat([raw[cut & ~window], hole]), pd.concat([raw[~cut], again]), raw[window]]
    for number, part in [*enumerate(parts), (2, parts[2])]:  # the last one is replayed
        write(spark.createDataFrame(part), number)
    got = spark.read.parquet(str(tmp_path / "features")).drop("month", "slot").toPandas()
    want = features.compact_features(spark.createDataFrame(raw)).toPandas()
    assert difference(got.round(5), want.round(5), atol=1e-4) is None


def test_only_rows_near_a_change_are_computed_again(spark, walk):
    raw = spark.createDataFrame(walk(3000, coins=("a", "b"))).selectExpr("*", "coin_id = 'a' AND timestamp = TIMESTAMP '2022-03-01 05:00:00' AS new")
    near = ingest.affected_places(raw, "new", reach=100).toPandas()
    changed = 59 * 24 + 5
    assert set(near["coin_id"]) == {"a"}
    hours = ((near["timestamp"] - pd.Timestamp("2022-01-01")).dt.total_seconds() // 3600).astype(int)
    block = changed // 100
    assert sorted(hours) == list(range((block - 1) * 100, (block + 2) * 100))
    assert sorted(hours[near["__again"]]) == list(range(block * 100, (block + 2) * 100))


def test_a_batch_without_new_rows_changes_nothing(spark, walk, tmp_path):
    raw = walk(60)
    write = ingest.correcting_writer(str(tmp_path / "history"), str(tmp_path / "features"))
    write(spark.createDataFrame(raw), 0)
    before = spark.read.parquet(str(tmp_path / "features")).toPandas()
    write(spark.createDataFrame(raw).where("false"), 1)
    assert difference(spark.read.parquet(str(tmp_path / "features")).toPandas(), before) is None


def test_a_version_is_visible_once_its_manifest_is(spark, tmp_path):
    base = str(tmp_path / "published")
    rows = spark.createDataFrame([(1, "x"), (2, None)], "`my col` int, b string")
    publish.stage_version(rows, base, "t", "1")
    assert publish.newest_version(spark, base, "t") is None
    with pytest.raises(FileNotFoundError):
        publish.read_version(spark, base, "t")
    first = publish.publish_version(rows, base, "t", "1").first()
    publish.publish_version(rows.limit(0), base, "t", "2")
    publish.stage_version(rows, base, "t", "3")
    assert publish.publish_version(rows, base, "t", "1").first() == first
    assert publish.newest_version(spark, base, "t") == "2" and publish.read_version(spark, base, "t").count() == 0
    assert sorted(publish.read_version(spark, base, "t", "1").collect(), key=str) == sorted(rows.collect(), key=str)
    with pytest.raises(ValueError):
        publish.publish_version(rows.limit(1), base, "t", "1")
