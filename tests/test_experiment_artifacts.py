"""End-to-end run on the smallest tables: metrics, saved models, config round trip."""

import os

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from dockcast.functions.columns import utc_stamp
from dockcast.operators.sequence import Sequencer
from dockcast.plans import experiment
from dockcast.sources import fixtures as fx
from dockcast.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_experiment_writes_and_reads_artifacts(spark, tmpdir_path):
    seq = Sequencer(order=fx.PANEL_ORDER)
    m = experiment.run(spark, fx.station_ts(spark, SF), seq, weather_hourly=fx.weather_hourly(spark, SF),
                       max_iter=3, out_dir=tmpdir_path)
    rows = m.orderBy("horizon_min").collect()
    assert [r.horizon_min for r in rows] == [15, 30, 60]
    assert all(r.gamma in (0.5, 0.7, 0.9, 1.0) for r in rows)
    cfg = sinks.read_config(spark, f"{tmpdir_path}/config")
    assert set(cfg["gammas"]) == {"15", "30", "60"} and len(cfg["feature_cols"]) == 26
    model = GBTRegressionModel.load(f"{tmpdir_path}/model_h30")
    assert model.numFeatures == 26
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/metrics").count() == 3


def test_utc_stamp(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    assert df.select(utc_stamp(F.col("ts"))).first()[0] == "20240102T030405Z"
