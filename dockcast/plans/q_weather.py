"""Queries over the hourly weather: scan, 5-minute grid, panel join, as-of join."""

from __future__ import annotations

from dockcast import config
from dockcast.operators import weather
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.sqltext import BASE, STATION_TS, W, with_

WCOLS = list(config.WEATHER_COLS)
WSPEC = [(c, "q") for c in WCOLS]

WEATHER_HOURLY = """weather_hourly AS (
  SELECT date_trunc('hour', ts) AS ts, avg(value) AS temperature_2m,
         CASE WHEN hour(date_trunc('hour', ts)) % 5 = 0 THEN NULL ELSE min(value) / 10 END AS precipitation,
         max(value) AS wind_speed_10m
  FROM events WHERE hour(ts) % 7 <> 6 GROUP BY date_trunc('hour', ts))"""

WFILL = "wfill AS (SELECT ts, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in WCOLS) + " FROM weather_hourly)"

W5 = ("w5 AS (SELECT unnest(generate_series(ts, nts, INTERVAL 5 MINUTE)) AS ts, " + ", ".join(WCOLS)
      + " FROM (SELECT *, COALESCE(lead(ts) OVER (ORDER BY ts) - INTERVAL 5 MINUTE, ts) AS nts FROM wfill) x)")


def add_weather_sql(src: str) -> str:
    """CTE ``aw``: ``src`` rows joined to the 5-min grid on floor(ts, 5 min),
    per-station ffill/bfill, then is_rain."""
    fills = ", ".join(
        f"COALESCE({c}, last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in WCOLS)
    return f"""aw0 AS (
  SELECT s.*, {', '.join('w.' + c + ' AS w_' + c for c in WCOLS)}
  FROM {src} s LEFT JOIN w5 w ON w.ts = make_timestamp(epoch_us(s.ts) - epoch_us(s.ts) % 300000000)),
aw1 AS (SELECT * EXCLUDE ({', '.join('w_' + c for c in WCOLS)}), {', '.join('w_' + c + ' AS ' + c for c in WCOLS)} FROM aw0),
aw2 AS (SELECT * EXCLUDE ({', '.join(WCOLS)}), {fills} FROM aw1),
aw AS (SELECT *, CASE WHEN precipitation > CAST(0.1 AS DOUBLE) THEN 1 ELSE 0 END AS is_rain FROM aw2)"""


@register("weather_scan", [("ts", "t")] + WSPEC, with_(WEATHER_HOURLY) + "SELECT {out} FROM weather_hourly")
def weather_scan(c):
    """Hourly weather table (hours 6, 13, 20 missing; some null precipitation)."""
    return c.weather_hourly


@register("weather_5min", [("ts", "t")] + WSPEC, with_(WEATHER_HOURLY, WFILL, W5) + "SELECT {out} FROM w5")
def weather_5min(c):
    """Hourly weather upsampled to the 5-minute grid with forward fill (gaps included)."""
    return c.weather_grid


@register("add_weather", KEYS + WSPEC + [("is_rain", "i")],
          with_(*BASE, WEATHER_HOURLY, WFILL, W5, add_weather_sql("panel")) + "SELECT {out} FROM aw")
def add_weather(c):
    """Panel ⟕ 5-min weather on the grid time; edges filled per station; rain flag."""
    return c.with_weather(c.panel)


@register("weather_asof", KEYS + WSPEC,
          with_(STATION_TS, WEATHER_HOURLY, WFILL) + """SELECT {out} FROM (
            SELECT p.station_id, p.ts, p.event_id, """ + ", ".join("w." + x for x in WCOLS) + """
            FROM station_ts p ASOF LEFT JOIN wfill w ON p.ts >= w.ts) x""")
def weather_asof(c):
    """Backward as-of join of raw timestamps to the filled hourly weather."""
    return weather.asof_hourly(c.raw, c.weather_hourly)
