import datetime as dt

import numpy as np

from dockcast.operators.grid import gap_report, missing_ticks
from dockcast.streaming import online


def test_gap_report(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", base + dt.timedelta(minutes=m)) for m in (0, 5, 7, 20)], "station_id string, ts timestamp_ntz")
    r = gap_report(df).collect()[0]
    assert (r.n_expected, r.n_present, r.n_missing) == (5, 3, 2)
    miss = sorted(x.tick for x in missing_ticks(df).collect())
    assert miss == [base + dt.timedelta(minutes=10), base + dt.timedelta(minutes=15)]


def test_array_features_follow_the_definitions():
    rng = np.random.default_rng(2)
    line = rng.random(90).astype(np.float32)
    line[[3, 40, 41]] = np.nan
    for cut in (0, 1, 20, 36, 60):
        got = online.batch_features(line[max(0, cut - online.KEEP):cut], line[cut:])
        for i in range(cut, len(line)):
            for c, k in online.LAGS.items():
                want = line[i - k] if i >= k else np.nan
                assert np.array_equal(got[c][i - cut], want, equal_nan=True)
            for c, k in online.ROLLS.items():
                want = line[i - k:i].astype(float).mean() if i >= k else np.nan
                assert np.isclose(got[c][i - cut], want, equal_nan=True)
            for c, k in online.DELTAS.items():
                assert np.isclose(got[c][i - cut], line[i] - line[i - k] if i >= k else np.nan, equal_nan=True)


def test_online_stream_serves_in_order_and_marks_late_readings(spark, tmpdir_path):
    base = dt.datetime(2024, 1, 1)
    land = f"{tmpdir_path}/readings"
    vals = [0.1 * i for i in range(15)]

    def reading(i, s="s"):
        return s, base + dt.timedelta(minutes=5 * i), 100 + i, vals[i]
    drops = [[reading(i) for i in (2, 0, 1, 3, 4)],                                  # out of order inside a batch is no fault
             [reading(i) for i in range(5, 10) if i != 7] + [reading(3)],            # 7 is missing, 3 comes again
             [reading(i) for i in range(10, 15)] + [reading(7), reading(0, "other"), reading(0, "other")]]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, "station_id string, ts timestamp, event_id long, occ float").coalesce(1).write.parquet(f"{land}/p{i}")
    q = online.start_online(spark, f"{land}/*", f"{tmpdir_path}/served", f"{tmpdir_path}/late", f"{tmpdir_path}/ck", max_files=1, available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmpdir_path}/served").where("station_id = 's'").orderBy("ts").toPandas()
    kept = [v for i, v in enumerate(vals) if i != 7]
    assert np.allclose(out["occ"], kept)
    assert np.isclose(out["occ_lag_5"].iloc[9], kept[8]) and np.isclose(out["occ_roll_15"].iloc[9], np.mean(kept[6:9]))
    assert np.isnan(out["occ_lag_60"].iloc[11]) and np.isclose(out["occ_lag_60"].iloc[12], kept[0])
    late = spark.read.parquet(f"{tmpdir_path}/late").toPandas()
    got = {(r.station_id, r.event_id, r.served_ts.to_pydatetime()) for r in late.itertuples()}
    assert len(late) == 3 and got == {("s", 103, base + dt.timedelta(minutes=20)), ("s", 107, base + dt.timedelta(minutes=45)), ("other", 100, base)}


def test_state_is_called_per_group_not_per_station(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(online, "GROUPS", 1)
    base = dt.datetime(2024, 1, 1)
    land = f"{tmpdir_path}/readings"
    schema = "station_id string, ts timestamp, event_id long, occ float"
    drops = [[(s, base + dt.timedelta(minutes=5 * i), 100 + i, 0.01 * i + n) for n, s in enumerate(["a", "b", None]) for i in at]
             for at in (range(0, 40), range(40, 60))]
    drops[1] += [("b", base, 1, 0.5), ("new", base, 1, 0.5)]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{land}/p{i}")
    q = online.start_online(spark, f"{land}/*", f"{tmpdir_path}/served", f"{tmpdir_path}/late", f"{tmpdir_path}/ck", max_files=1, available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmpdir_path}/served").toPandas()
    assert len(out) == 181
    for n, s in enumerate(["a", "b", None]):
        own = out[out["station_id"].isna() if s is None else out["station_id"] == s].sort_values("ts")
        line = np.array([0.01 * i + n for i in range(60)], np.float32)
        assert np.array_equal(own["occ"], line)
        for c, want in online.batch_features(line[:0], line).items():
            assert np.array_equal(own[c], want, equal_nan=True)
    late = spark.read.parquet(f"{tmpdir_path}/late").collect()
    assert [(r.station_id, r.event_id, r.served_ts) for r in late] == [("b", 1, base + dt.timedelta(minutes=195))]


def test_missing_ticks_joins_days_not_ticks(spark):
    base = dt.datetime(2024, 1, 1, 22, 0)
    at = [("a", 0), ("a", 7), ("a", 3 * 1440 + 3), ("b", 10), (None, 0), (None, 10)]
    df = spark.createDataFrame([(s, base + dt.timedelta(minutes=m)) for s, m in at] + [("c", None), ("a", None)], "station_id string, ts timestamp_ntz")
    out = missing_ticks(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(CASE") < plan.index("Join")             # ticks come out after the join
    got = {(x.station_id, x.tick) for x in out.collect()}
    want = {("a", base + dt.timedelta(minutes=5 * i)) for i in range(2, 3 * 288)} | {(None, base + dt.timedelta(minutes=m)) for m in (0, 5, 10)}
    assert got == want
