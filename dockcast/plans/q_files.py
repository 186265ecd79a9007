"""Queries that write the station tables as files, broken records among them, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import micros
from dockcast.plans.catalog import register
from dockcast.plans.q_weather import WEATHER_HOURLY, WSPEC
from dockcast.plans.sqltext import STATION_TS, with_
from dockcast.session import table_folder
from dockcast.sources import checked, sinks, versions
from dockcast.sources.panel_files import PANEL_SCHEMA, WEATHER_SCHEMA

# every 41st panel line has a broken time, every 43rd a broken number, every 47th no station
_PANEL_GOOD = "event_id % 41 <> 0 AND event_id % 43 <> 0 AND event_id % 47 <> 0"
_PANEL_WHY = ("CASE WHEN event_id % 41 = 0 THEN 'unreadable ts' WHEN event_id % 43 = 0 THEN 'unreadable bikes_available' "
              "WHEN event_id % 47 = 0 THEN 'no station_id' END")


def _stamp(ts, pattern):
    return F.date_format(ts, pattern)


def _panel_file(c):
    """The raw panel as CSV: another column order, an extra column, three ways to write a time."""
    k = F.col("event_id") % 3
    text = (F.when(F.col("event_id") % 41 == 0, F.lit("soon")).when(k == 0, _stamp("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(k == 1, F.concat(_stamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
            .otherwise(F.concat(_stamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))))
    lines = c.raw.select("capacity", F.when(F.col("event_id") % 47 != 0, F.col("station_id")).alias("station_id"),
                         F.col("event_id").alias("extra"), text.alias("ts"),
                         F.when(F.col("event_id") % 43 == 0, F.lit("n/a")).otherwise(F.col("bikes_available").cast("string")).alias("bikes_available"))
    path = table_folder(c.spark)
    lines.write.option("header", True).csv(path)
    return checked.read_csv(c.spark, path, PANEL_SCHEMA, ["ts", "station_id"])


@register("panel_csv", [("station_id", "s"), ("ts", "t"), ("bikes_available", "q"), ("capacity", "q")],
          with_(STATION_TS) + f"""SELECT {{out}} FROM (
            SELECT station_id, CASE WHEN event_id % 3 = 2 THEN ts - INTERVAL 2 HOURS ELSE ts END AS ts, bikes_available, capacity
            FROM station_ts WHERE {_PANEL_GOOD}) x""")
def panel_csv(c):
    """The panel written as CSV and read back by name; times with and without a zone; broken records set aside."""
    return checked.good(_panel_file(c))


def _weather_file(c):
    text = F.when(F.hour("ts") == 3, F.lit("?")).otherwise(_stamp("ts", "yyyy-MM-dd HH:mm:ss"))
    path = table_folder(c.spark)
    c.weather_hourly.select("wind_speed_10m", "precipitation", text.alias("ts"), "temperature_2m").write.option("header", True).csv(path)
    return checked.read_csv(c.spark, path, WEATHER_SCHEMA, ["ts"])


@register("weather_csv", [("ts", "t")] + WSPEC, with_(WEATHER_HOURLY) + "SELECT {out} FROM weather_hourly WHERE hour(ts) <> 3")
def weather_csv(c):
    """Hourly weather written as CSV and read back; the rows of hour 3 have unreadable times and are set aside."""
    return checked.good(_weather_file(c))


def _weather_documents(c):
    """A document per day, as the archive serves it; every seventh is cut short, every fifth lacks the wind, hour 4 has a broken time."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    number = F.floor(micros("_day") / 86_400_000_000)
    time = F.when(F.hour("ts") == 4, F.lit("four")).otherwise(_stamp("ts", "yyyy-MM-dd'T'HH:mm"))
    rows = c.weather_hourly.select(day.alias("_day"), F.struct("ts", time.alias("time"), *config.WEATHER_COLS).alias("r"))
    days = rows.groupBy("_day").agg(F.sort_array(F.collect_list("r")).alias("r")).withColumn("_n", number)      # at most 24 rows a day

    def values(name):
        return F.transform("r", lambda x: x[name])
    hourly = F.struct(values("time").alias("time"), *[F.when(F.lit(v != "wind_speed_10m") | (F.col("_n") % 5 != 0), values(v)).alias(v)
                                                      for v in config.WEATHER_COLS])
    text = F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})
    cut = F.when(F.col("_n") % 7 == 0, F.substring(text, 1, 40)).otherwise(text)
    path = table_folder(c.spark)
    days.select(cut.alias("value")).write.text(path)
    return checked.read_hourly_documents(c.spark, path)


_DAYS = "days AS (SELECT *, epoch_us(date_trunc('day', ts)) // 86400000000 AS n FROM weather_hourly)"


@register("weather_json", [("ts", "t")] + WSPEC, with_(WEATHER_HOURLY, _DAYS) + """SELECT {out} FROM (
            SELECT ts, temperature_2m, precipitation, CASE WHEN n % 5 <> 0 THEN wind_speed_10m END AS wind_speed_10m
            FROM days WHERE n % 7 <> 0 AND hour(ts) <> 4) x""")
def weather_json(c):
    """Columnar weather documents read back as hourly rows; broken documents and times set aside, a missing variable is null."""
    return checked.good(_weather_documents(c))


@register("panel_rejects", [("source", "s"), ("reject", "s"), ("n", "l")],
          with_(STATION_TS, WEATHER_HOURLY, _DAYS) + f"""SELECT {{out}} FROM (
            SELECT 'panel_csv' AS source, {_PANEL_WHY} AS reject, count(*) AS n FROM station_ts WHERE NOT ({_PANEL_GOOD}) GROUP BY ALL
            UNION ALL SELECT 'weather_csv', 'unreadable ts', count(*) FROM weather_hourly WHERE hour(ts) = 3 HAVING count(*) > 0
            UNION ALL SELECT 'weather_json', 'not a document', count(DISTINCT n) FROM days WHERE n % 7 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'weather_json', 'unreadable time', count(*) FROM days WHERE n % 7 <> 0 AND hour(ts) = 4 HAVING count(*) > 0) x""")
def panel_rejects(c):
    """Records of the three kinds of file that were set aside, counted by reason."""
    files = {"panel_csv": _panel_file(c), "weather_csv": _weather_file(c), "weather_json": _weather_documents(c)}
    out = None
    for name, df in files.items():
        part = checked.reject_counts(df).withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@register("snapshot_sink", [("kind", "s"), ("station_id", "s"), ("ts", "t"), ("bikes_available", "q"), ("capacity", "q")],
          with_(STATION_TS) + """, t AS (SELECT station_id, ts, bikes_available, capacity, event_id FROM station_ts)
            SELECT {out} FROM (SELECT 'history' AS kind, * EXCLUDE (event_id) FROM t
            UNION ALL (SELECT 'latest', * EXCLUDE (event_id) FROM t QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) = 1)) x""")
def snapshot_sink(c):
    """Snapshots written by the sink and read back: the day-partitioned history and the committed ``latest`` version."""
    path = table_folder(c.spark)
    sinks.write_snapshots(c.raw.select("station_id", F.col("ts").alias("snapshot_ts"), "bikes_available", "capacity"), path)
    names = ["station_id", F.col("snapshot_ts").alias("ts"), "bikes_available", "capacity"]
    history = c.spark.read.parquet(f"{path}/snapshots").select(F.lit("history").alias("kind"), *names)
    return history.unionByName(versions.read(c.spark, f"{path}/latest").select(F.lit("latest").alias("kind"), *names))


@register("weather_sink", [("ts", "t")] + WSPEC, with_(WEATHER_HOURLY) + "SELECT {out} FROM weather_hourly")
def weather_sink(c):
    """Hourly weather written by its sink and read back by the plain reader."""
    from dockcast.sources.panel_files import read_weather
    path = table_folder(c.spark)
    sinks.write_weather(c.weather_hourly, path)
    return read_weather(c.spark, path)
