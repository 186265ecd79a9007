"""Long series, outages longer than any look-back, files in other shapes."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from dockcast.operators import features, grid
from dockcast.operators.sequence import Sequencer
from dockcast.sources.panel_files import read_panel, read_weather


def _series(n, seed):
    rng = np.random.default_rng(seed)
    occ = rng.random(n)
    occ[1000:1350] = np.nan
    occ[5000:5400] = np.nan
    part = slice(2000, 4500)
    occ[part] = np.where(rng.random(len(occ[part])) < 0.9, np.nan, occ[part])
    occ[:3] = np.nan
    return occ


@pytest.mark.parametrize("strategy", ["key", "blocked"])
def test_ema_is_exact_over_outages_and_batches(spark, strategy):
    base = dt.datetime(2024, 1, 1)
    series = {"a": _series(10_400, 1), "b": _series(6_000, 2), "c": np.full(40, np.nan)}
    rows = [(s, base + dt.timedelta(minutes=5 * i), i, None if np.isnan(v) else float(v))
                         for s, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, event_id long, occ double").repartition(5)
    seq = Sequencer("station_id", ("ts", "event_id"), strategy, block_rows=700)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "900")
    try:
        got = features.build_features(df, seq, use_ema=True, targets=False).select("station_id", "event_id", "occ_ema_fast", "occ_ema_slow", "occ_momentum").toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(rows)
    for s, x in series.items():
        g = got[got.station_id == s].sort_values("event_id")
        for col, alpha in (("occ_ema_fast", 0.5), ("occ_ema_slow", 0.1)):
            want = pd.Series(x).shift(1).ewm(alpha=alpha, adjust=False).mean().to_numpy()
            have = g[col].to_numpy(dtype="float64", na_value=np.nan)
            assert (np.isnan(want) == np.isnan(have)).all()
            assert np.nanmax(np.abs(want - have), initial=0) <= 1e-6


@pytest.mark.parametrize("strategy", ["key", "blocked"])
@pytest.mark.parametrize("forward", [True, False])
def test_fill_equals_pandas(spark, strategy, forward):
    x = _series(3_000, 3)
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", base + dt.timedelta(minutes=5 * i), i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)],
                               "station_id string, ts timestamp_ntz, event_id long, v double")
    out = Sequencer("station_id", ("ts", "event_id"), strategy).fill(df, "v", forward=forward)
    got = out.select("event_id", "v").toPandas().sort_values("event_id")["v"].to_numpy()
    s = pd.Series(x)
    want = (s.ffill() if forward else s).bfill().to_numpy()
    assert np.allclose(got, want, equal_nan=True)
    assert "CurrentRow, specifiedwindowframe(RowFrame, currentrow$(), unboundedfollowing$()" not in out._jdf.queryExecution().toString()


def test_csv_columns_by_name_and_zoned_times(spark, tmp_path):
    (tmp_path / "p.csv").write_text("capacity,extra,station_id,ts,bikes_available\n10,x,A,2024-01-01 00:00:00+00:00,3\n,y,B,2024-01-01T02:05:00+02:00,\n12,z,C,2024-01-01 00:10:00,4.5\n5,z,D,,1\n")
    got = sorted(map(tuple, read_panel(spark, str(tmp_path / "p.csv")).collect()), key=lambda r: r[1])
    t = [dt.datetime(2024, 1, 1, 0, m) for m in (0, 5, 10)]
    assert got == [(t[0], "A", 3.0, 10.0), (t[1], "B", None, None), (t[2], "C", 4.5, 12.0), (None, "D", 1.0, 5.0)]
    (tmp_path / "w.csv").write_text("ts,wind_speed_10m,temperature_2m,precipitation,more\n2024-01-01T00:00:00Z,1.5,-2,0,9\n")
    assert [tuple(r) for r in read_weather(spark, str(tmp_path / "w.csv")).collect()] == [(t[0], -2.0, 0.0, 1.5)]
    (tmp_path / "bad.csv").write_text("ts,station_id,bikes_available,capacity\nnot a time,A,1,2\n")
    with pytest.raises(Exception):
        read_panel(spark, str(tmp_path / "bad.csv")).collect()


def test_gaps_of_whole_days_are_reported(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 23, 0)), ("a", dt.datetime(2024, 1, 3, 1, 0)), ("b", dt.datetime(2024, 1, 1, 0, 2))]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz")
    missing = grid.missing_ticks(df).groupBy("station_id").count().collect()
    report = {r.station_id: r.n_missing for r in grid.gap_report(df).collect()}
    assert {r.station_id: r["count"] for r in missing} == {"a": 311} and report == {"a": 311, "b": 0}
