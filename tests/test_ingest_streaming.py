"""GBFS documents with both spellings, weather JSON, sinks, and stream = batch."""

import datetime as dt
import json
import os

import pytest

from dockcast.sources import gbfs, sinks, versions, weather_json
from dockcast.streaming import gbfs_polls, snapshots


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f)


def test_gbfs_alias_both_spellings(spark, tmpdir_path):
    info = {"data": {"stations": [{"station_id": s, "name": f"n{s}", "lat": 48.8, "lon": 2.3, "capacity": 20, "stationCode": s}
                                  for s in ("1", "2", "3", "4")]}}
    status = {"last_updated": 1, "data": {"stations": [
        {"station_id": "1", "num_bikes_available": 3, "num_docks_available": 7, "is_installed": 1, "stationCode": "1"},
        {"station_id": "2", "numBikesAvailable": 4, "numDocksAvailable": 6, "is_installed": 1},
        {"station_id": "3", "num_bikes_available": 5, "numBikesAvailable": 9, "num_docks_available": 5}]}}
    _write(f"{tmpdir_path}/info/a.json", info)
    _write(f"{tmpdir_path}/status/a.json", status)
    snap = gbfs.read_snapshot(spark, f"{tmpdir_path}/info", f"{tmpdir_path}/status")
    got = {r.station_id: r for r in snap.collect()}
    assert set(got) == {"1", "2", "3"}                                    # inner join
    assert got["1"].num_bikes_available == 3 and got["2"].num_bikes_available == 4
    assert got["3"].num_bikes_available == 5                              # snake_case wins
    assert "stationCode" not in snap.columns and snap.columns[-1] == "snapshot_ts"
    assert snap.columns[:11] == ["station_id", "name", "lat", "lon", "capacity", "is_installed", "is_renting",
                                 "is_returning", "last_reported", "num_bikes_available", "num_docks_available"]


def test_weather_json_missing_variable(spark, tmpdir_path):
    _write(f"{tmpdir_path}/w/a.json", {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                                  "temperature_2m": [1.5, 2.5], "precipitation": [0.0, 0.2]}})
    rows = weather_json.read_hourly_json(spark, f"{tmpdir_path}/w").orderBy("ts").collect()
    assert [r.temperature_2m for r in rows] == [1.5, 2.5]
    assert rows[0].wind_speed_10m is None and rows[1].ts == dt.datetime(2024, 1, 1, 1)


def test_snapshot_sink_and_latest(spark, tmpdir_path):
    df = spark.createDataFrame([("1", 3, dt.datetime(2024, 1, 1, 0, 0)), ("1", 4, dt.datetime(2024, 1, 1, 0, 1)),
                                ("2", 5, dt.datetime(2024, 1, 1, 0, 0))], "station_id string, num_bikes_available int, snapshot_ts timestamp_ntz")
    sinks.write_snapshots(df, tmpdir_path, "parquet")
    latest = {r.station_id: r.num_bikes_available for r in versions.read(spark, f"{tmpdir_path}/latest").collect()}
    assert latest == {"1": 4, "2": 5}
    assert spark.read.parquet(f"{tmpdir_path}/snapshots").count() == 3
    with pytest.raises(ValueError):
        sinks.write_snapshots(df, tmpdir_path, "xml")


def test_late_snapshots_stream_equals_batch(spark, tmpdir_path):
    base = dt.datetime(2024, 1, 1)
    land = f"{tmpdir_path}/landing"
    batches = [
        [("1", 3, base + dt.timedelta(minutes=1)), ("1", 4, base + dt.timedelta(minutes=3))],
        [("1", 4, base + dt.timedelta(minutes=3)), ("2", 1, base + dt.timedelta(minutes=2))],     # duplicate
        [("1", 6, base + dt.timedelta(minutes=7)), ("1", 2, base + dt.timedelta(minutes=4))],     # out of order
        [("1", 9, base + dt.timedelta(minutes=40))],                                              # moves the watermark
    ]
    schema = snapshots.SNAPSHOT_SCHEMA
    for i, b in enumerate(batches):
        rows = [(s, None, None, None, 20.0, 1, 1, 1, None, float(n), None, t) for s, n, t in b]
        df = spark.createDataFrame(rows, schema)
        if i == 0:                                                                                # whole numbers, as the document reader writes them
            df = df.withColumn("num_bikes_available", df.num_bikes_available.cast("int")).withColumn("num_docks_available", df.num_docks_available.cast("int"))
        df.coalesce(1).write.mode("overwrite").parquet(f"{land}/b{i}")
    q = snapshots.start_panel(spark, f"{land}/*", f"{tmpdir_path}/panel", f"{tmpdir_path}/ckpt", available_now=True)
    q.awaitTermination(120)
    streamed = {(r.station_id, r.ts): r.bikes_available for r in spark.read.parquet(f"{tmpdir_path}/panel").collect()}
    batch_in = spark.read.schema(schema).parquet(f"{land}/*").dropDuplicates(["station_id", "snapshot_ts"])
    batch = {(r.station_id, r.ts): r.bikes_available for r in snapshots.to_panel(batch_in).collect()}
    closed = {k: v for k, v in batch.items() if k[1] < base + dt.timedelta(minutes=30)}   # ticks closed by the watermark
    assert streamed == closed                      # late but inside the watermark: counted by event time
    assert streamed[("1", base)] == 2.0 and streamed[("1", base + dt.timedelta(minutes=5))] == 6.0


def test_ingest_and_latest_streams(spark, tmpdir_path):
    base = dt.datetime(2024, 1, 1)
    land = f"{tmpdir_path}/land"
    schema = snapshots.SNAPSHOT_SCHEMA
    for i in range(3):
        rows = [(s, None, None, None, 20.0, 1, 1, 1, None, 10.0 * i + int(s), None, base + dt.timedelta(minutes=i))
                for s in ("1", "2")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{land}/p{i}")
    q1 = snapshots.start_ingest(spark, f"{land}/*", f"{tmpdir_path}/table", f"{tmpdir_path}/ck1", available_now=True)
    q1.awaitTermination(120)
    assert spark.read.parquet(f"{tmpdir_path}/table").count() == 6
    q2 = snapshots.start_latest(spark, f"{land}/*", f"{tmpdir_path}/latest", f"{tmpdir_path}/ck2", available_now=True)
    q2.awaitTermination(120)
    latest = {r.station_id: r.num_bikes_available for r in versions.read(spark, f"{tmpdir_path}/latest").collect()}
    assert latest == {"1": 21, "2": 22}


def test_gbfs_polls_pair_by_stamp(spark, tmpdir_path):
    for stamp, bikes in (("20240101T000000Z", 1), ("20240101T000100Z", 2)):
        _write(f"{tmpdir_path}/info/info_{stamp}.json",
               {"data": {"stations": [{"station_id": "7", "name": "x", "lat": 1.0, "lon": 2.0, "capacity": 10}]}})
        _write(f"{tmpdir_path}/status/status_{stamp}.json",
               {"data": {"stations": [{"station_id": "7", "num_bikes_available": bikes}]}})
    rows = gbfs.read_polls(spark, f"{tmpdir_path}/info", f"{tmpdir_path}/status").orderBy("snapshot_ts").collect()
    assert [(r.num_bikes_available, r.snapshot_ts) for r in rows] == [
        (1, dt.datetime(2024, 1, 1, 0, 0)), (2, dt.datetime(2024, 1, 1, 0, 1))]


def test_a_version_counts_once_its_pointer_is_written(spark, tmpdir_path):
    out = f"{tmpdir_path}/t"

    def rows(n):
        return spark.createDataFrame([(n,)], "n int")
    assert versions.read(spark, out) is None and versions.current(spark, out) is None
    assert versions.commit(rows(0), out) == 0
    versions.write(rows(1), out, 1)                                        # a crash before the pointer
    assert versions.read(spark, out).first().n == 0
    assert versions.commit(rows(11), out, 1) == 1                          # the repeated write replaces it
    assert versions.read(spark, out).first().n == 11 and versions.read(spark, out, before=1).first().n == 0
    for n in (2, 3, 4):
        versions.commit(rows(n), out, fmt="parquet")
    assert versions.current(spark, out) == 4
    assert sorted(d for d in os.listdir(out) if d.startswith("version=")) == ["version=3", "version=4"]
    versions.commit(rows(5), f"{out}-csv", fmt="csv")
    assert versions.read(spark, f"{out}-csv", fmt="csv").first().n == 5


def test_document_streams_join_within_a_poll(spark, tmpdir_path):
    """Information and status of three polls; one status is late but in time, one comes after its state is gone, one never."""
    info_dir, status_dir = f"{tmpdir_path}/i", f"{tmpdir_path}/s"
    t0 = 1_704_067_200

    def info(n, s="7"):
        return {"last_updated": t0 + 300 * n - 20, "data": {"stations": [{"station_id": s, "name": f"p{n}", "lat": 1.0, "lon": 2.0, "capacity": 10}]}}

    def status(n, s="7", field="num_bikes_available"):
        return {"last_updated": t0 + 300 * n, "data": {"stations": [{"station_id": s, field: n}]}}
    plan = [([info(0)], [status(0)]), ([info(1)], [status(1, field="numBikesAvailable")]), ([info(2)], []), ([info(3)], [status(3), status(2)]),
            ([info(8)], [status(8)]), ([info(9)], [status(9), status(1, "7")])]
    for i, (a, b) in enumerate(plan):
        for folder, docs in ((info_dir, a), (status_dir, b)):
            path = f"{folder}/{i:02d}.json"
            os.makedirs(folder, exist_ok=True)
            with open(path, "w") as f:
                f.write("\n".join(json.dumps(d) for d in docs) + "\n")
            os.utime(path, (t0 + i, t0 + i))
    q = gbfs_polls.start_polls(spark, info_dir, status_dir, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", delay="10 minutes", max_files=1, available_now=True)
    q.awaitTermination(120)
    got = {(r.name, r.num_bikes_available, r.snapshot_ts) for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    at = dt.datetime(2024, 1, 1)
    assert got == {(f"p{n}", n, at + dt.timedelta(minutes=5 * n)) for n in (0, 1, 2, 3, 8, 9)}
