"""Windows over time instead of rows: lags and means that mean minutes where readings are missing or uneven.

A station's rows are cut into chunks of time; rows that lie within the look-back of
the next chunk are copied into it, so a window never needs more than one chunk and
its halo, however long the history is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import floor_ts, micros

CHUNK_SECONDS = 86_400


def time_windowed(df: DataFrame, back_seconds: int, build: Callable[[DataFrame, Window], DataFrame], key: Sequence[str] = ("station_id",),
                  ts: str = "ts", chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``build(df, w)`` with ``w`` ordered by ``_sec`` (seconds) over one key's rows; it may look back ``back_seconds`` by range frames.

    Chunks are at least as wide as the look-back, so a row is copied once at most.
    """
    width = max(chunk_seconds, back_seconds)
    sec = F.floor(micros(ts) / 1_000_000)
    d = df.withColumn("_sec", sec).withColumn("_chunk", F.floor(F.col("_sec") / width))
    late = F.col("_sec") >= (F.col("_chunk") + 1) * width - back_seconds
    copies = F.array_compact(F.array(F.struct(F.col("_chunk").alias("c"), F.lit(True).alias("home")),
                                     F.when(late, F.struct((F.col("_chunk") + 1).alias("c"), F.lit(False).alias("home")))))
    d = d.withColumn("_copy", F.explode(copies)).withColumn("_chunk", F.col("_copy.c")).withColumn("_home", F.col("_copy.home")).drop("_copy")
    return build(d, Window.partitionBy(*key, "_chunk").orderBy("_sec")).where("_home").drop("_sec", "_chunk", "_home")


def on_grid(panel: DataFrame, value: str = "occ", order: Sequence[str] = ("ts", "event_id"), freq_min: int = config.FREQ_MIN) -> DataFrame:
    """(station_id, ts, value): the last reading of every grid tick that has one."""
    tick = panel.withColumn("_tick", floor_ts("ts", freq_min * 60))
    return tick.groupBy("station_id", "_tick").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_r")).select(
        "station_id", F.col("_tick").alias("ts"), f"_r.{value}")


def time_lags(grid: DataFrame, value: str = "occ", prefix: str = "occ", lags=config.LAG_STEPS, rolls=config.ROLL_STEPS,
              freq_min: int = config.FREQ_MIN, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``{prefix}_tlag_m``: the value exactly m minutes before (null if that tick has none); ``{prefix}_tmean_m`` and
    ``{prefix}_tcount_m``: mean and number of the known values in the m minutes before the row's tick.

    Rows are unique per station and tick (``on_grid``).
    """
    step = freq_min * 60

    def build(d: DataFrame, w: Window) -> DataFrame:
        columns = {f"{prefix}_tlag_{k * freq_min}": F.max(value).over(w.rangeBetween(-k * step, -k * step)) for k in lags}
        for k in rolls:
            frame = w.rangeBetween(-k * step, -1)
            columns[f"{prefix}_tmean_{k * freq_min}"] = F.avg(value).over(frame)
            columns[f"{prefix}_tcount_{k * freq_min}"] = F.count(value).over(frame)
        return d.withColumns(columns)
    return time_windowed(grid, max([*lags, *rolls]) * step, build, chunk_seconds=chunk_seconds)
