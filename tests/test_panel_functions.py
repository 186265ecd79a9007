"""Scalar traps: null-preserving clip, ANSI division, weekday base, UTC parsing."""

import datetime as dt

from pyspark.sql import functions as F

from dockcast.functions.columns import calendar_columns, occupancy, occupancy_serving, quantize, utc_normalise


def test_occupancy_clip_and_nulls(spark):
    df = spark.createDataFrame([(None, 10.0), (15.0, 10.0), (-1.0, 10.0), (5.0, 0.0), (5.0, None)], "b double, c double")
    got = [r[0] for r in df.select(occupancy(F.col("b"), F.col("c"))).collect()]
    assert got[0] is None and got[1] == 1.0 and got[2] == 0.0
    assert got[3] is None and got[4] is None               # try_divide under ANSI, no error
    serving = [r[0] for r in df.select(occupancy_serving(F.col("b"), F.col("c"))).collect()]
    assert serving == [0.0, 1.0, 0.0, 0.0, 0.0]


def test_week_edges_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 23, 55),), (dt.datetime(2024, 1, 8, 0, 0),)], "ts timestamp_ntz")
    cal = calendar_columns(F.col("ts"))
    rows = df.select(cal["dow"].alias("d"), cal["is_weekend"].alias("w"), cal["hour"].alias("h")).collect()
    assert [(r.d, r.w, r.h) for r in rows] == [(6, 1, 23), (0, 0, 0)]


def test_utc_normalise(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+02:00",)], "s string")
    got = [r[0] for r in df.select(utc_normalise(F.col("s"))).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 8)]


def test_quantize_is_exact_power_of_two(spark):
    df = spark.createDataFrame([(0.5,), (1 / 3,), (None,)], "x double")
    got = [r[0] for r in df.select(quantize(F.col("x"))).collect()]
    assert got[0] == 0.5 and abs(got[1] - 1 / 3) < 1e-6 and got[2] is None
