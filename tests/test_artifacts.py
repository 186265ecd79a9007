"""Models saved and loaded again give the numbers of the fitted ones, on batches and on requests."""

import datetime as dt

import numpy as np

from dockcast import config
from dockcast.plans import artifacts, models

COLS = ["occ_now", "occ_lag_5", "occ_delta_5", "capacity"]


def _fitted(spark):
    rng = np.random.default_rng(3)
    now, lag = rng.random(400), rng.random(400)
    rows = [(float(a), float(b), float(a - b), 20.0, float(0.4 * (b - a))) for a, b in zip(now, lag)]
    d = spark.createDataFrame(rows, "occ_now double, occ_lag_5 double, occ_delta_5 double, capacity double, label double")
    m = models.gbt(config.GBT_DELTA, 4).fit(models.assemble(d, COLS))
    return d, artifacts.Artifacts({15: m, 60: m}, COLS, {"15": 0.7, "60": 1.0})


def test_save_load_score(spark, tmpdir_path):
    frame, art = _fitted(spark)
    artifacts.save_artifacts(spark, tmpdir_path, art)
    back = artifacts.load_artifacts(spark, tmpdir_path)
    assert (back.feat_cols, back.gammas, sorted(back.models)) == (COLS, art.gammas, [15, 60])
    names = ["pred_bikes_15", "pred_bikes_60"]
    a = artifacts.score_frame(frame, art).select(names).toPandas()
    b = artifacts.score_frame(frame, back).select(names).toPandas()
    assert np.array_equal(a.to_numpy(), b.to_numpy())

    ts = dt.datetime(2024, 1, 1, 12)
    req = spark.createDataFrame([("a", 5.0, 20.0, ts, [2.0, 9.0], [15, 45]), ("b", 12.0, 20.0, ts, [], None), ("c", None, 20.0, ts, [1.0], [60])],
                                "station_id string, bikes_available double, capacity double, ts timestamp_ntz, history_5min array<double>, horizons array<int>")
    got = {(r.station_id, r.horizon_min): r for r in artifacts.score_requests(req, back, requested="horizons").collect()}
    assert set(got) == {("a", 15), ("b", 15), ("b", 60), ("c", 60)} and got["c", 60].predicted_bikes is None
    one = spark.createDataFrame([(0.25, 0.45, 0.25 - 0.45, 20.0)], "occ_now float, occ_lag_5 float, occ_delta_5 float, capacity float")
    delta = 0.7 * art.models[15].transform(models.assemble(one, COLS)).first()["prediction"]
    assert abs(got["a", 15].predicted_bikes - min(max(5.0 + delta * 20.0, 0.0), 20.0)) <= 5e-4
