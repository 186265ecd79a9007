"""Inputs of the reference's data model, derived by Spark from the given tables.

The driver tables are TPC-H-like plus ``events``.  They map onto the
station model as follows (the same text runs in DuckDB, see
``dockcast.plans.sql``):

* ``station_ts`` — the station panel: one ``events`` user is one station,
  ``value`` the bikes count, capacity known only on ``signup`` rows and
  deliberately broken for some stations (0 or never known) so the fill and
  filter paths run;
* ``weather_hourly`` — one hourly weather table built from ``events``
  (hours 6, 13 and 20 missing, some null precipitation);
* ``station_info`` / ``station_status`` — GBFS-like documents from
  ``supplier`` and ``lineitem`` with both field spellings;
* ``score_requests_in`` — the latest reading of each station with up to
  13 preceding values as history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.columns import floor_ts, micros
from dockcast.operators.sequence import Sequencer
from dockcast.sources.tables import read_table

PANEL_ORDER = ("ts", "event_id")


def station_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    u = F.col("user_id")
    cap = (F.when(u % 50 == 0, F.lit(0))
            .when(u % 50 == 1, F.lit(None))
            .when(F.col("event_type") == "signup", F.lit(20) + u % 40))
    return e.select(
        u.cast("string").alias("station_id"), "ts", "event_id",
        F.when(F.col("event_id") % 37 == 0, F.lit(None)).otherwise(F.col("value")).cast("float").alias("bikes_available"),
        cap.cast("float").alias("capacity"))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["ts", "value"])
    e = e.where(F.hour("ts") % 7 != 6).withColumn("hts", floor_ts("ts", 3600))
    return (e.groupBy("hts")
             .agg(F.avg("value").alias("temperature_2m"), F.min("value").alias("_mn"), F.max("value").alias("wind_speed_10m"))
             .select(F.col("hts").alias("ts"), "temperature_2m",
                     F.when(F.hour("hts") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("_mn") / 10).alias("precipitation"),
                     "wind_speed_10m"))


def station_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return s.select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        (F.lit(48.80) + F.col("s_nationkey") / 100.0).alias("lat"),
        (F.lit(2.25) + F.col("s_acctbal") / 100000.0).alias("lon"),
        (F.lit(20) + F.col("s_suppkey") % 40).cast("double").alias("capacity"))


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows with snake_case, camelCase or both spellings by station."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_quantity", "l_shipdate"])
    g = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"), F.max("l_shipdate").alias("last"))
    k = F.col("l_suppkey") % 3
    bikes = (F.col("n") % 30).cast("int")
    docks = (F.col("q").cast("long") % 25).cast("int")
    return g.select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.lit(1).alias("is_installed"),
        F.when(F.col("n") % 7 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_renting"),
        F.lit(1).alias("is_returning"),
        (micros(F.col("last")) / 1_000_000).cast("long").alias("last_reported"),
        F.when(k != 1, bikes).alias("num_bikes_available"),
        F.when(k != 0, bikes + 1).alias("numBikesAvailable"),
        F.when(k != 1, docks).alias("num_docks_available"),
        F.when(k != 0, docks + 2).alias("numDocksAvailable"))


def score_requests_in(spark: SparkSession, sf_dir: str, seq: Sequencer | None = None, long_history: bool = False) -> DataFrame:
    """Latest event per station as a scoring request with its history array.

    Histories hold up to 13 known values, or with ``long_history`` up to 36 readings of
    which some are null.  Runs on the bounded ``Sequencer`` windows (13 or 36 rows back,
    1 ahead), so a station with a huge history is still split into bounded tasks.
    """
    back = 36 if long_history else 13
    seq = seq or Sequencer(key="user_id", order=PANEL_ORDER,
                           strategy=spark.conf.get("dockcast.sequence.strategy", "auto"),
                           block_rows=int(spark.conf.get("dockcast.sequence.strategy.blockRows", "4096")))
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    e = e.withColumn("bikes", F.when(F.col("event_id") % 37 == 0, F.lit(None)).otherwise(F.col("value")))

    def build(d, w):
        return d.withColumns({
            "_h": (F.transform(F.collect_list(F.struct("bikes")).over(w.rowsBetween(-back, -1)), lambda r: r["bikes"])
                   if long_history else F.collect_list("bikes").over(w.rowsBetween(-back, -1))),   # the latter skips nulls
            "_last": F.lead("ts", 1).over(w).isNull()})

    u = F.col("user_id")
    n = (F.greatest(F.lit(0), F.lit(36) - u % 14 * 3) if long_history else u % 14).cast("int")
    last_n = F.when(n == 0, F.array().cast("array<double>")).otherwise(
        F.slice(F.col("_h"), F.greatest(F.lit(1), F.size("_h") - n + 1), n))
    return (seq.windowed(e, back, 1, build)
              .where("_last")
              .select(u.cast("string").alias("station_id"),
                      F.coalesce(F.col("bikes"), F.lit(0.0)).alias("bikes_available"),
                      F.when(u % 50 == 0, F.lit(0.0)).otherwise((F.lit(20) + u % 40).cast("double")).alias("capacity"),
                      "ts",
                      F.when(u % 17 == 0, F.lit(None).cast("array<double>")).otherwise(last_n).alias("history_5min")))
