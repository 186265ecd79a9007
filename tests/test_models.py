"""Gamma grid picks the best; reconstruction clips; patience."""

import numpy as np
from pyspark.sql import functions as F

from dockcast.plans import models


def test_calibration_prefers_lower_error(spark):
    rows = [(30, 0.5, 0.2, 10.0, 0.6)] * 5                      # truth = occ_now + 0.5 * delta
    best = models.calibrate_gamma(spark.createDataFrame(rows, "horizon_min int, occ_now double, delta double, capacity double, y_occ double"))
    got = {r.gamma: r.mae_val for r in best.collect()}
    assert min(got, key=got.get) == 0.5
    assert best.where("is_best").first().gamma == 0.5


def test_reconstruct_clips(spark):
    df = spark.createDataFrame([(0.9, 0.5, 20.0), (0.1, -0.5, 20.0)], "o double, d double, c double")
    got = [r[0] for r in df.select(models.reconstruct_bikes(F.col("o"), F.lit(1.0), F.col("d"), F.col("c"))).collect()]
    assert got == [20.0, 0.0]


def test_approx_options(spark):
    import datetime as dt
    from dockcast.operators import encode, quality
    base = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([("s", base + dt.timedelta(minutes=5 * i), float(i % 4) / 4) for i in range(12)],
                               "station_id string, ts timestamp_ntz, occ double")
    exact = encode.station_hour_median(df).first().sta_hdh_occ
    approx = encode.station_hour_median(df, approx=True).first().sta_hdh_occ
    assert abs(exact - approx) <= 0.25
    assert quality.panel_counts(df, approx=True).first().n_stations == 1


def test_patience_rule():
    assert models.stopped_round([5, 4, 3, 3, 3, 2], 2) == 3          # two rounds without a lower error end the search
    assert models.stopped_round([5, 4, 3, 3, 3, 2], 3) == 6
    assert models.stopped_round([1.0], 50) == 1


def test_growing_budgets_find_the_round_of_one_long_run(spark):
    rng = np.random.default_rng(5)
    x = rng.random((500, 2))
    y = np.sin(6 * x[:, 0]) + 0.3 * rng.normal(size=500)
    df = spark.createDataFrame([(float(a), float(b), float(t), i % 5 == 0) for i, ((a, b), t) in enumerate(zip(x, y))],
                               "a double, b double, label double, is_val boolean").coalesce(1)
    small = dict(loss="squared", metric="squared", rounds=40, patience=4, step=0.5, rows=0.8, columns="all", leaf=5)
    model, best = models.fit_patient(df, ["a", "b"], small)
    d = models.assemble(df, ["a", "b"])
    errors = models.gbt(small).fit(d.where("not is_val")).evaluateEachIteration(d.where("is_val"), "squared")
    assert best == models.stopped_round(errors, 4) == model.getNumTrees
    none, rounds = models.fit_patient(df.withColumn("is_val", F.lit(False)), ["a", "b"], dict(small, rounds=3))
    assert rounds == none.getNumTrees == 3
