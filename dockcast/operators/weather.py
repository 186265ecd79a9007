"""Weather: hourly -> 5-minute grid, as-of join, per-station edge fill, rain flag.

The weather table has one location and no station key; its size grows with
the time span only (8,760 hours a year), never with the number of stations,
so after a size check it is broadcast to the panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import floor_ts, rain_flag
from dockcast.operators.dims import sized_join
from dockcast.operators.sequence import Sequencer


def fill_hourly(hourly: DataFrame, cols=config.WEATHER_COLS) -> DataFrame:
    """Forward fill each variable along time (one location: a small,
    unpartitioned window over the hourly rows only)."""
    w = Window.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select("ts", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])


def expand_to_grid(hourly: DataFrame, cols=config.WEATHER_COLS, freq_min: int = config.FREQ_MIN) -> DataFrame:
    """Upsample to the ``freq_min`` grid from the first to the last hour, forward filled.

    Each filled hourly row expands to the grid points up to the next row,
    so gaps (missing hours) take the previous values, as reindex + ffill does.
    """
    step = F.expr(f"INTERVAL {freq_min} MINUTES")
    f = fill_hourly(hourly, cols).withColumn("_next", F.lead("ts").over(Window.orderBy("ts")))
    end = F.coalesce(F.col("_next") - step, F.col("ts"))
    return f.select(F.explode(F.sequence("ts", end, step)).alias("ts"), *cols)


def add_weather(frame: DataFrame, grid: DataFrame, seq: Sequencer, on: str = "ts",
                cols=config.WEATHER_COLS) -> DataFrame:
    """Left join on the grid time, per-station ffill/bfill of what is missing
    at the edges, then ``is_rain``."""
    g = grid.select(F.col("ts").alias(on), *cols) if on != "ts" else grid
    out = sized_join(frame, g, on, "left")
    out = seq.fill(out, list(cols))
    return out.withColumn("is_rain", rain_flag(F.col("precipitation")))


def asof_hourly(frame: DataFrame, hourly: DataFrame, cols=config.WEATHER_COLS, ts: str = "ts") -> DataFrame:
    """Backward as-of join of any timestamp to hourly weather.

    Hourly rows sit on the hour, so the latest row at or before ``ts`` is the
    filled row of ``floor(ts, 1 h)`` (clamped to the last hour): an equi-join
    on a completed hourly grid replaces a range join.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    f = fill_hourly(hourly, cols).withColumn("_next", F.lead("ts").over(Window.orderBy("ts")))
    full = f.select(F.explode(F.sequence("ts", F.coalesce(F.col("_next") - hour, F.col("ts")), hour)).alias("_wh"), *cols)
    bounds = F.broadcast(hourly.agg(F.min("ts").alias("_w0"), F.max("ts").alias("_w1")))
    d = frame.crossJoin(bounds).withColumn(
        "_wh", F.when(F.col(ts) >= F.col("_w0"), F.least(floor_ts(ts, 3600), F.col("_w1"))))
    return sized_join(d, full, "_wh", "left").drop("_wh", "_w0", "_w1")
