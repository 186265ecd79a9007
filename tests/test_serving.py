"""Request features for history lengths 0/1/5/12/20/null, gamma ties, horizon filter."""

import datetime as dt


from dockcast.plans import models, scoring


def _req(spark):
    ts = dt.datetime(2024, 1, 1, 12)
    hs = [[], [5.0], [1.0, 2.0, 3.0, 4.0, 5.0], [float(i) for i in range(12)], [float(i) for i in range(20)], None]
    return spark.createDataFrame([(str(i), 5.0, 10.0, ts, h) for i, h in enumerate(hs)],
                                 "station_id string, bikes_available double, capacity double, ts timestamp_ntz, history_5min array<double>")


def test_history_lengths_compat(spark):
    got = {r.station_id: r for r in scoring.history_features(_req(spark), mode="compat").collect()}
    assert got["0"].occ_lag_5 == 0.5 and got["0"].occ_roll_60 == 0.5           # empty -> occ_now
    assert got["5"].occ_lag_5 == 0.5                                           # null history
    assert got["1"].occ_lag_5 == 0.5 and got["1"].occ_lag_10 == 0.5
    assert abs(got["2"].occ_roll_60 - 0.3) < 1e-12 and got["2"].occ_lag_15 == 0.3
    assert got["4"].occ_lag_60 == 0.8 and got["4"].occ_roll_180 == got["4"].occ_roll_60   # last 12 of 20
    assert abs(got["2"].occ_delta_5 - 0.0) < 1e-12


def test_history_consistent_needs_full_windows(spark):
    got = {r.station_id: r for r in scoring.history_features(_req(spark), mode="consistent").collect()}
    assert got["2"].occ_lag_30 is None and got["2"].occ_roll_15 is not None
    assert got["4"].occ_roll_120 is None and got["3"].occ_roll_60 is not None


def test_history_consistent_keeps_unknown_readings(spark):
    ts = dt.datetime(2024, 1, 1, 12)
    rows = [("gap", 5.0, 10.0, ts, [1.0, None, 3.0, 4.0]), ("none", None, 10.0, ts, [1.0]), ("cap0", 5.0, 0.0, ts, [1.0])]
    req = spark.createDataFrame(rows, "station_id string, bikes_available double, capacity double, ts timestamp_ntz, history_5min array<double>")
    got = {r.station_id: r for r in scoring.history_features(req).collect()}
    assert got["gap"].occ_lag_15 is None and got["gap"].occ_roll_15 is None and got["gap"].occ_lag_5 == 0.4
    assert got["none"].occ_now is None and got["none"].occ_delta_5 is None and got["none"].occ_lag_5 == 0.1
    assert got["cap0"].occ_now is None and got["cap0"].occ_lag_5 is None


def test_gamma_tie_first_in_grid_wins(spark):
    val = spark.createDataFrame([(15, 0.5, 0.0, 10.0, 0.5)] * 4, "horizon_min int, occ_now double, delta double, capacity double, y_occ double")
    best = models.calibrate_gamma(val).where("is_best").collect()
    assert len(best) == 1 and best[0]["gamma"] == 0.5


def test_predict_long_and_nested(spark):
    al = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 5.0, 10.0, 0.1, 0.2, 0.3, [15, 45])],
                               "station_id string, ts timestamp_ntz, bikes_available double, capacity double, d15 double, d30 double, d60 double, horizons array<int>")
    long = scoring.predict(al, {15: "d15", 30: "d30", 60: "d60"}, {"15": 0.5}, requested="horizons").collect()
    assert [(r.horizon_min, r.predicted_bikes, r.delta_model) for r in long] == [(15, 5.5, 0.05)]
    nested = scoring.predict(al, {15: "d15", 30: "d30", 60: "d60"}, {}, long=False).collect()[0]
    assert set(nested.predictions) == {"15", "30", "60"} and nested.predictions["60"].predicted_bikes == 8.0
    hf = scoring.horizon_filter(al).collect()
    assert [(r.horizon_min, r.accepted) for r in hf] == [(15, True), (45, False)]


def test_align_defaults(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 5.0, 10.0, 0.5)],
                               "station_id string, ts timestamp_ntz, bikes_available double, capacity double, occ_now double")
    out = scoring.align(df, ["occ_now", "hour_sin2", "sta_mean_occ", "capacity"]).collect()[0]
    assert out.hour_sin2 == 0.0 and out.sta_mean_occ == 0.5 and out.capacity == 10.0 and out.capacity_in == 10.0
