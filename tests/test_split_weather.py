"""Exact quantile, split edges, delta targets at the cut, weather grid and as-of."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockcast.operators import split, weather
from dockcast.operators.quantile import exact_quantile
from dockcast.operators.sequence import Sequencer


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60), st.sampled_from([0.0, 0.3, 0.5, 0.7, 0.85, 1.0]),
       st.sampled_from([None, 7.0]))
def test_exact_quantile_matches_numpy(spark, xs, q, width):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = exact_quantile(df, F.col("v"), q, bins=8, width=width).collect()[0]
    assert got["n"] == len(xs)
    assert abs(got["q"] - float(np.quantile(np.array(xs, dtype=float), q))) < 1e-9


def test_split_edge_and_delta_targets(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("s", base + dt.timedelta(minutes=5 * i), float(i) / 10) for i in range(10)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, occ float")
    cut = split.temporal_cut(df, 0.7)
    c = cut.collect()[0]
    m = [int((r[1] - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for r in rows]
    assert c["cut_us"] == int(np.floor(np.quantile(m, 0.7)))
    train, test = split.split_frames(df, cut=cut)
    assert train.count() + test.count() == 10 and train.count() == 7   # cut on a tick: ts <= cut is train
    seq = Sequencer(order=("ts",), strategy="key")
    w = seq.key_window()
    feat = df.withColumns({"occ_15": F.lead("occ", 3).over(w), "ts_15": F.lead("ts", 3).over(w),
                           "occ_30": F.lead("occ", 6).over(w), "ts_30": F.lead("ts", 6).over(w),
                           "occ_60": F.lead("occ", 12).over(w), "ts_60": F.lead("ts", 12).over(w)})
    got = split.delta_targets(feat, cut).orderBy("ts").toPandas()
    tr = got.iloc[:7]
    assert tr["occ_delta_target_15"].notna().sum() == 4              # last 3 train rows have no in-split target
    te = got.iloc[7:]
    assert te["occ_delta_target_15"].isna().all()                     # fewer than 3 rows after each


def test_weather_gaps_match_pandas_reindex(spark):
    base = dt.datetime(2024, 1, 1)
    hours = [0, 1, 3, 4]                                              # hour 2 missing
    rows = [(base + dt.timedelta(hours=h), float(h), None if h == 1 else h / 10, 5.0) for h in hours]
    hourly = spark.createDataFrame(rows, "ts timestamp_ntz, temperature_2m double, precipitation double, wind_speed_10m double")
    got = weather.expand_to_grid(hourly).orderBy("ts").toPandas()
    p = pd.DataFrame(rows, columns=["ts", "temperature_2m", "precipitation", "wind_speed_10m"]).set_index("ts")
    exp = p.reindex(pd.date_range(p.index.min(), p.index.max(), freq="5min")).ffill()
    assert len(got) == len(exp)
    assert np.allclose(got["temperature_2m"], exp["temperature_2m"])
    assert np.allclose(got["precipitation"].fillna(-1), exp["precipitation"].fillna(-1))


def test_asof_hourly(spark):
    base = dt.datetime(2024, 1, 1)
    hourly = spark.createDataFrame([(base, 1.0, 0.0, 1.0), (base + dt.timedelta(hours=2), 3.0, 0.5, 1.0)],
                                   "ts timestamp_ntz, temperature_2m double, precipitation double, wind_speed_10m double")
    pts = spark.createDataFrame([(base - dt.timedelta(minutes=1),), (base + dt.timedelta(minutes=90),),
                                 (base + dt.timedelta(hours=5),)], "ts timestamp_ntz")
    got = [r["temperature_2m"] for r in weather.asof_hourly(pts, hourly).orderBy("ts").collect()]
    assert got == [None, 1.0, 3.0]


def test_grouped_exact_quantile(spark):
    rows = [("a", float(x)) for x in range(11)] + [("b", float(x)) for x in (5, 1, 9, 9)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in exact_quantile(df, F.col("v"), 0.85, by=["g"], width=2.0).collect()}
    assert abs(got["a"] - np.quantile(np.arange(11.0), 0.85)) < 1e-9
    assert abs(got["b"] - np.quantile([5.0, 1.0, 9.0, 9.0], 0.85)) < 1e-9
