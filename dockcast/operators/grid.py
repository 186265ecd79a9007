"""Regular-grid check: which 5-minute ticks a station is missing.

Row-based lags mean minutes only on a gap-free grid.  The check needs no
grid expansion: per station, expected ticks = (last - first) / step + 1 and
present ticks = distinct floored timestamps — one aggregate with partial
aggregation.  ``missing_ticks`` expands the grid only for stations that have
gaps, one bounded ``sequence`` per station and day, less the day's present ticks
inside that row: days are joined, never ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import floor_ts, from_micros, micros
from dockcast.operators.dims import materialise


def gap_report(panel: DataFrame, freq_min: int = config.FREQ_MIN) -> DataFrame:
    step = freq_min * 60 * 1_000_000
    t = panel.select("station_id", floor_ts("ts", freq_min * 60).alias("tick"))
    agg = t.groupBy("station_id").agg(F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"),
                                      F.countDistinct("tick").alias("n_present"))
    expected = ((micros("last_tick") - micros("first_tick")) / step).cast("long") + 1
    return agg.select("station_id", "first_tick", "last_tick", expected.alias("n_expected"), "n_present",
                      (expected - F.col("n_present")).alias("n_missing"))


def missing_ticks(panel: DataFrame, freq_min: int = config.FREQ_MIN) -> DataFrame:
    """(station_id, day, tick) of every grid point without a reading, between a station's first and last tick; day is its midnight."""
    step, day = freq_min * 60 * 1_000_000, 86_400_000_000
    t = panel.select("station_id", micros(floor_ts("ts", freq_min * 60)).alias("tick")).filter("tick IS NOT NULL")
    days = materialise(t.groupBy("station_id", (F.col("tick") - F.pmod("tick", F.lit(day))).alias("day")).agg(F.collect_set("tick").alias("present")))
    bounds = days.groupBy("station_id").agg(F.min(F.array_min("present")).alias("_lo"), F.max(F.array_max("present")).alias("_hi"))
    first = F.col("_lo") - F.pmod("_lo", F.lit(day))
    every = bounds.withColumn("day", F.explode(F.sequence(first, "_hi", F.lit(day))))  # also days without any reading
    grid = F.sequence(F.greatest("day", "_lo"), F.least(F.col("day") + (day - step), "_hi"), F.lit(step))
    missing = F.when(F.col("present").isNull(), grid).otherwise(F.array_except(grid, "present"))
    # a named number of partitions: few bytes become many ticks here, so tasks must not be merged by their size
    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (every.repartition(parts, "station_id", "day").join(days.repartition(parts, "station_id", "day"), ["station_id", "day"], "left")
            .select("station_id", from_micros(F.col("day")).alias("day"), F.explode(missing).alias("tick"))
            .select("station_id", "day", from_micros(F.col("tick")).alias("tick")))
