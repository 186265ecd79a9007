"""Queries of the general as-of join: irregular right rows, ties, gaps, both directions, with and without a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast.functions.columns import floor_ts, from_micros, micros
from dockcast.operators.asof import asof_join
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.q_weather import WCOLS, WEATHER_HOURLY, WSPEC
from dockcast.plans.sqltext import STATION_TS, with_
from dockcast.sources.tables import read_table

MSPEC = [("m_ts", "t"), ("m_id", "q"), ("m_value", "q")]

# a second stream per station: every third reading, up to two minutes early or late, to the minute (so times tie)
METER = """meter AS (SELECT station_id, m_ts, m_id, m_value FROM (
  SELECT CAST(user_id AS VARCHAR) AS station_id, date_trunc('minute', ts + to_seconds((event_id % 7 - 3) * 37)) AS m_ts,
         event_id AS m_id, value AS m_value FROM events WHERE event_id % 3 = 0) x
  QUALIFY row_number() OVER (PARTITION BY station_id, m_ts ORDER BY m_id DESC) = 1)"""


def _meter(c):
    e = read_table(c.spark, c.sf, "events", ["event_id", "ts", "user_id", "value"]).where("event_id % 3 = 0")
    shift = (F.col("event_id") % 7 - 3) * 37 * 1_000_000
    return (e.withColumn("m_ts", from_micros(micros("ts") + shift)).withColumn("m_ts", floor_ts("m_ts", 60))
            .select(F.col("user_id").cast("string").alias("station_id"), "m_ts", F.col("event_id").alias("m_id"), F.col("value").alias("m_value")))


@register("asof_any", KEYS + MSPEC, with_(STATION_TS, METER) + """SELECT {out} FROM (
            SELECT p.station_id, p.ts, p.event_id, m.m_ts, m.m_id, m.m_value
            FROM station_ts p ASOF LEFT JOIN meter m ON p.station_id = m.station_id AND p.ts >= m.m_ts) x""")
def asof_any(c):
    """Last reading of a second, irregular stream of the same station at or before each raw row."""
    return asof_join(c.raw, _meter(c), ["m_ts", "m_id", "m_value"], right_ts="m_ts", by=["station_id"], ties=["m_id"])


@register("asof_forward", KEYS + MSPEC, with_(STATION_TS, METER) + """SELECT {out} FROM (
            SELECT station_id, ts, event_id, CASE WHEN near THEN m_ts END AS m_ts, CASE WHEN near THEN m_id END AS m_id,
                   CASE WHEN near THEN m_value END AS m_value
            FROM (SELECT p.station_id, p.ts, p.event_id, m.m_ts, m.m_id, m.m_value, m.m_ts - p.ts <= INTERVAL 12 HOURS AS near
                  FROM station_ts p ASOF LEFT JOIN meter m ON p.station_id = m.station_id AND p.ts < m.m_ts) y) x""")
def asof_forward(c):
    """First reading of the second stream strictly after each raw row, if within twelve hours."""
    return asof_join(c.raw, _meter(c), ["m_ts", "m_id", "m_value"], right_ts="m_ts", by=["station_id"], ties=["m_id"],
                     forward=True, exact=False, within_seconds=12 * 3600)


@register("asof_weather_any", KEYS + WSPEC + [("w_ts", "t")], with_(STATION_TS, WEATHER_HOURLY, """off_hour AS (
            SELECT ts + to_minutes(hour(ts) * 7 % 60) AS w_ts, * EXCLUDE (ts) FROM weather_hourly)""") + """SELECT {out} FROM (
            SELECT p.station_id, p.ts, p.event_id, w.* FROM station_ts p ASOF LEFT JOIN off_hour w ON p.ts >= w.w_ts) x""")
def asof_weather_any(c):
    """Weather reported at any minute of the hour, as of each raw row (one location, no key)."""
    late = (F.hour("ts") * 7 % 60).cast("long") * 60_000_000
    reports = c.weather_hourly.withColumn("w_ts", from_micros(micros("ts") + late)).drop("ts")
    return asof_join(c.raw, reports, [*WCOLS, "w_ts"], right_ts="w_ts")
